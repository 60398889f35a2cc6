"""Lint rules over skill texts: each is an expression that gives an array of findings; the catalogue is a list of them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import body, frontmatter, has_frontmatter, strip, text_of

FINDING = "struct<rule:string,severity:string,message:string,line:int,fix_hint:string>"
# How a name and a description are read, and the rules' ids below.
NAME_VALUE = r"(?m)^name\s*:\s*(.+?)\s*$"
DESCRIPTION_VALUE = r"(?m)^description\s*:\s*(\S(?:.*\S)?)\s*$"
# Phrases that say when to use a skill; references that have aged, with rule names.
TRIGGERS = ("use this", "use when", "when ", "for ", "to ")
OUTDATED = (
    (r"\bdeepseek[- ]?v3\.1\b", "I001-outdated-model"),
    (r"\bgpt-3\.5-turbo\b", "I002-deprecated-model"),
    (r"\bclaude-2(?:\.[01])?\b", "I003-deprecated-model"),
    (r"\bclaude-instant\b", "I004-deprecated-model"),
    (r"\btext-davinci-(?:002|003)\b", "I005-deprecated-model"),
    (r"\bcode-davinci-002\b", "I006-deprecated-model"),
    (r"\bopenai\.Completion\.create\b", "I007-legacy-api"),
    (r"\bopenai\.ChatCompletion\.create\b", "I008-legacy-api"),
)
#: What a line of each has, in lower case; looked for before the pattern.
OUTDATED_WORDS = ("deepseek", "gpt-3.5-turbo", "claude-2", "claude-instant", "text-davinci-00", "code-davinci-002", "openai.completion.create", "openai.chatcompletion.create")
Rule = Callable[[Column], Column]


def finding(rule: str, severity: str, message: Column | str, line: Column | int | None = None, hint: str | None = None) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), as_col(message).alias("message"),
        as_col(line).cast("int").alias("line"), F.lit(hint).cast("string").alias("fix_hint"),
    )


def only_if(when: Column, f: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.array(f)).otherwise(F.array().cast(f"array<{FINDING}>"))


def frontmatter_rule(c: Column) -> Column:
    return only_if(~has_frontmatter(c), finding("E001-no-frontmatter", "error", "No frontmatter block at the top", 1, "Begin with a --- block that has a name and a description"))


def field_rules(c: Column) -> Column:
    fm, has = frontmatter(c), has_frontmatter(c)
    return F.concat(
        only_if(has & ~fm.rlike(NAME_VALUE), finding("E002-missing-name", "error", "The frontmatter has no name", 1, "Add a name in kebab case")),
        only_if(has & ~fm.rlike(DESCRIPTION_VALUE), finding("E003-missing-description", "error", "The frontmatter has no description", 1, "Say when the skill applies")),
    )


def description_text(c: Column) -> Column:
    """The description without quotes; of a block scalar the indented lines below, joined; null without one."""
    fm = frontmatter(c)
    bare = F.regexp_replace(strip(F.regexp_extract(fm, DESCRIPTION_VALUE, 1)), r"^[\"']+|[\"']+\z", "")
    lines = F.split(fm, "\n")
    # 1-based place of the first line of the description
    at = F.array_position(F.transform(lines, lambda x: strip(x).startswith("description:")), True).cast("int")
    rest = F.slice(lines, at + 1, F.size(lines))
    stop = F.array_position(F.transform(rest, lambda x: x.startswith("  ") | x.startswith("\t")), False).cast("int")
    block = F.array_join(F.transform(F.slice(rest, F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size(rest))), strip), " ")
    return F.when(has_frontmatter(c) & fm.rlike(DESCRIPTION_VALUE), F.when(bare.startswith("|"), block).otherwise(bare))


def description_rules(c: Column) -> Column:
    d = description_text(c)
    n = F.length(d)
    says_when = F.lit(False)
    for t in TRIGGERS:
        says_when = says_when | F.lower(d).contains(t)
    return F.concat(
        only_if(n < 20, finding("W001-short-description", "warning", F.concat(F.lit("Description of "), n.cast("string"), F.lit(" characters")), None, "One to three sentences")),
        only_if(n > 1000, finding("W002-long-description", "warning", F.concat(F.lit("Description of "), n.cast("string"), F.lit(" characters")), None, "Move details into the body")),
        only_if(~says_when, finding("W003-no-trigger-language", "warning", "The description does not say when to use the skill", None, "Begin with: use this when")),
    )


def fence_rule(c: Column) -> Column:
    """One finding per opening fence without a language: fence lines with an even place among the fences open."""
    lines = F.transform(F.split(c, "\n"), lambda x, i: F.struct((i + 1).cast("int").alias("n"), strip(x).alias("t")))
    fences = F.filter(lines, lambda x: x["t"].startswith("```"))
    bare = F.filter(fences, lambda x, i: (i % 2 == 0) & (strip(F.substr(x["t"], F.lit(4))) == ""))
    none = F.array().cast(f"array<{FINDING}>")
    return F.when(~c.contains("```"), none).otherwise(F.transform(bare, lambda x: finding("W004-codeblock-no-lang", "warning", "A code fence without a language", x["n"], "Name the language after the fence")))


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda x: x.rlike("(?i)" + pattern)


def outdated_rules(c: Column) -> Column:
    """The first line of each reference that has aged."""
    lines = F.split(c, "\n")
    out = []
    for (pattern, rule), word in zip(OUTDATED, OUTDATED_WORDS, strict=True):
        line = F.array_position(F.transform(lines, _matches(pattern)), True)
        # the array is gone through only for texts that match at all
        out.append(only_if(F.lower(c).contains(word) & c.rlike("(?i)" + pattern), finding(rule, "info", "A reference that may have aged", line, "Check the current name")))
    return F.concat(*out)


def heading_rule(c: Column) -> Column:
    head = F.array_join(F.slice(F.split(body(c), "\n"), 1, 50), "\n")
    return only_if(~head.rlike(r"(?m)^#{1,2}\s"), finding("W005-no-heading", "warning", "No heading near the top of the body", None, "Begin the body with a heading"))


def length_rule(c: Column) -> Column:
    n = F.length(strip(body(c)))
    return only_if(n < 200, finding("W006-short-body", "warning", F.concat(F.lit("Body of "), n.cast("string"), F.lit(" characters"))))


RULES: list[Rule] = [frontmatter_rule, field_rules, description_rules, fence_rule, outdated_rules, heading_rule, length_rule]


def lint(c: Column, rules: list[Rule] | None = None) -> Column:
    """All findings of a text; null counts as empty."""
    c = text_of(c)
    return F.concat(*[r(c) for r in (rules or RULES)])


def custom_rule(name: str, check: Callable[[str], list[tuple[str, str, str, int | None, str | None]]]) -> Rule:
    """A rule written in Python: check(text) gives (rule, severity, message, line, fix_hint) tuples. A text it fails on has no
    findings of this rule, and keeps those of all others."""

    @F.pandas_udf(f"array<{FINDING}>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            try:
                out.append([dict(zip(("rule", "severity", "message", "line", "fix_hint"), f, strict=True)) for f in check(t or "")])
            except Exception:
                out.append([])
        return pd.Series(out, dtype=object)

    run.__name__ = name
    return lambda c: run(c)


def lint_files(files: DataFrame) -> DataFrame:
    """files (path, content as bytes, null where a file could not be read) -> (path, findings): bytes that are no UTF-8 are read with
    replacements; a file that could not be read has one finding that says so."""
    unread = F.array(finding("E000-read-error", "error", "The file could not be read"))
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files.select("path", F.when(F.col("content").isNull(), unread).otherwise(lint(F.coalesce(text, F.lit("")))).alias("findings"))
