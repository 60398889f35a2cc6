"""Quality tags as expressions, and sets of them."""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import strip, text_of, valid_frontmatter

# Tags by what they rule out.
NOT_CLEAN = ("bot_author", "whitespace_change", "revert_subject", "pre_revert", "merge_commit", "duplicate_pair", "micro_edit", "short_skill")
NOT_CURATED = (*NOT_CLEAN, "invalid_frontmatter", "same_author_dup")
NOT_STRICT = ("no_license", "low_engagement", "placeholder_content", "pii_email")
# Senders that are machines. The first two are case-sensitive.
BOTS = (r"\[bot\]@", r"^(noreply|action)@github\.com$", r"(?i)\bdependabot\b", r"(?i)\brenovate\b", r"(?i)\bgithub-actions\b", r"(?i)\bsemantic-release\b")
# Text that was never filled in; attempts to steer a reader model; mail domains that belong to nobody.
PLACEHOLDERS = (
    r"(?i)<your\s+\w+\s+here>", r"(?i)<your[-\s_][^>]{0,30}>", r"(?i)\bTODO:\s*(?:fill|add|write|complete|implement)", r"(?i)\blorem\s+ipsum\b",
    r"(?i)\bplaceholder\s+(?:text|content)\b", r"(?i)\bhello,?\s*world\b", r"(?i)\bfoo\s*bar\s*baz\b",
)
INJECTIONS = (
    r"(?i)ignore (?:all )?previous (?:instructions?|messages?|prompts?|context)", r"(?i)disregard (?:all )?(?:prior|previous|earlier)",
    r"(?i)\byou are now (?:[a-z][a-z0-9_]+|in [a-z]+ mode)", r"(?i)\bdeveloper mode\b", r"(?i)\bjailbroken?\b", r"\bDAN(?:[ -]mode)?\b",
    r"(?i)\boverride (?:your |the )?(?:safety|guidelines|restrictions?)",
)
MAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
NOBODY = ("example.com", "example.org", "example.net", "users.noreply.github.com", "noreply.github.com", "domain.com", "yourdomain.com", "test.com", "local")


#: What every match of a pattern has, in lower case: looked for first, as finding a word is far cheaper than a pattern.
PLACEHOLDER_WORDS = ("<your", "<your", "todo:", "lorem", "placeholder", "hello", "foo")
INJECTION_WORDS = ("previous", "disregard", "you are now ", "developer mode", "jailbroke", "dan", "override ")


def any_of(c: Column, patterns: tuple[str, ...], words: tuple[str, ...] = ()) -> Column:
    """Whether a text matches one of the patterns; false for null. words: for every pattern, what a text it matches must have."""
    out, low = F.lit(False), F.lower(c)
    for p, w in zip_longest(patterns, words):
        out = out | (c.rlike(p) if w is None else low.contains(w) & c.rlike(p))
    return F.coalesce(out, F.lit(False))


def bot_email(c: Column) -> Column:
    return any_of(c, BOTS)


def pii_email(c: Column) -> Column:
    """Whether a text holds a mail address whose domain is neither documentation nor no-reply."""
    domain = lambda m: F.lower(F.substring_index(m, "@", -1))
    personal = lambda m: ~(domain(m).isin(*NOBODY) | domain(m).rlike(r"\.(example|local|test)$") | domain(m).contains("noreply"))
    return F.coalesce(c.contains("@") & F.exists(F.regexp_extract_all(c, F.lit(MAIL), 0), personal), F.lit(False))


def tag(name: str, when: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.lit(name))


def tag_array(*tags: Column) -> Column:
    """The tags that hold, sorted."""
    return F.array_sort(F.array_compact(F.array(*tags)))


def size_facts() -> dict[str, Column]:
    """What base tags and scores ask of the texts of a revision."""
    after, before = text_of("after_content"), text_of("before_content")
    return {"after_length": F.length(after), "before_length": F.length(before), "replaced": after.contains("�") | before.contains("�")}


def base_tags(kind: Column, duplicate_after: Column, duplicate_pair: Column, before_revert: Column) -> Column:
    """The tags of one revision with size_facts; kind is its intent class, the other three come from its neighbours."""
    subject = strip(text_of("commit_subject"))
    first = F.coalesce(F.col("is_initial"), F.lit(False))
    zero = F.lit(0)
    small = (F.coalesce("lines_added", zero) <= 2) & (F.coalesce("lines_removed", zero) <= 2) & (F.abs(F.coalesce("char_delta", zero)) < 40)
    return tag_array(
        tag("bot_author", bot_email(F.col("commit_email"))),
        tag("whitespace_change", kind == "whitespace"),
        tag("merge_commit", kind == "merge"),
        tag("revert_subject", F.lower(subject).startswith("revert")),
        tag("initial_commit", first),
        tag("short_skill", (F.col("after_length") < 500) & ~first),
        tag("large_blob", (F.col("before_length") > 200_000) | (F.col("after_length") > 200_000)),
        tag("non_utf8_clean", F.col("replaced")),
        tag("micro_edit", ~first & small),
        tag("duplicate_after", duplicate_after),
        tag("duplicate_pair", duplicate_pair),
        tag("pre_revert", before_revert),
    )


def content_tags(after: Column) -> Column:
    """The tags that the text alone decides."""
    return tag_array(
        tag("invalid_frontmatter", ~valid_frontmatter(after)),
        tag("placeholder_content", any_of(after, PLACEHOLDERS, PLACEHOLDER_WORDS)),
        tag("pii_email", pii_email(after)),
        tag("prompt_injection_pattern", any_of(after, INJECTIONS, INJECTION_WORDS)),
    )


def repo_tags(known: Column, spdx: Column, stars: Column, pushed_at: Column, as_of: Column) -> Column:
    """no_license and low_engagement; a repository that is not known gets neither. as_of stands for today."""
    unlicensed = F.coalesce(spdx, F.lit("")) == ""
    recent = F.coalesce(F.try_to_timestamp(pushed_at) >= as_of - F.expr("interval 1 year"), F.lit(False))
    known = F.coalesce(known, F.lit(False))
    return tag_array(tag("no_license", known & unlicensed), tag("low_engagement", known & unlicensed & (F.coalesce(stars, F.lit(0)) == 0) & ~recent))


def quality_score(tags: Column, spdx: Column, stars: Column, pr_title: Column, kind: Column, after_length: Column) -> Column:
    """The weighted sum of what speaks for a record, at most 1; a float."""
    part = lambda w, when: F.when(F.coalesce(when, F.lit(False)), F.lit(w)).otherwise(F.lit(0.0))
    none_of = lambda names: ~F.arrays_overlap(F.coalesce(tags, F.array().cast("array<string>")), F.array(*map(F.lit, names)))
    total = (
        part(0.20, spdx != "") + part(0.10, stars >= 10) + part(0.10, stars >= 100) + part(0.15, pr_title != "")
        + part(0.20, none_of(NOT_CURATED)) + part(0.10, none_of(NOT_STRICT)) + part(0.05, kind.isin("feat", "fix", "refactor", "docs"))
        + part(0.10, after_length.between(500, 30_000))
    )
    return F.least(total, F.lit(1.0)).cast("float")
