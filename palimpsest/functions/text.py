"""Text expressions: stripping, frontmatter, headings, fences, paths, hashes. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must behave as documented for the corpus's formats; fixed values.
FRONTMATTER = r"(?s)\A---\s*\r?\n(.*?)\r?\n---\s*\r?\n"
NAME_PRESENT = r"(?m)^name\s*:\s*\S+"
DESCRIPTION_PRESENT = r"(?m)^description\s*:\s*\S"
HEADING = r"(?m)^(#{1,2})\s+(.+?)\s*$"
FENCE_LINE = r"(?m)^```"


def strip(c: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def text_of(c: Column | str) -> Column:
    """The text, or '' for null."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def has_frontmatter(c: Column) -> Column:
    return c.rlike(FRONTMATTER)


def frontmatter(c: Column) -> Column:
    return F.regexp_extract(c, FRONTMATTER, 1)


def body(c: Column) -> Column:
    return F.regexp_replace(c, FRONTMATTER, "")


def valid_frontmatter(c: Column) -> Column:
    """Frontmatter with a name and a description; false for null."""
    fm = frontmatter(c)
    return F.coalesce(has_frontmatter(c) & fm.rlike(NAME_PRESENT) & fm.rlike(DESCRIPTION_PRESENT), F.lit(False))


def headings(c: Column) -> Column:
    """Headings of the first two levels, in order."""
    return F.transform(F.regexp_extract_all(c, F.lit(HEADING), 2), strip)


def code_blocks(c: Column) -> Column:
    """Pairs of fence lines."""
    return F.floor(F.regexp_count(c, F.lit(FENCE_LINE)) / 2).cast("int")


def stable_id(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-1 over the parts, each followed by a NUL."""
    return F.left(F.sha1(F.concat(*[x for p in parts for x in (text_of(p), F.lit("\x00"))])), F.lit(16))


def short_id(c: Column) -> Column:
    """First 16 hex digits of a text's SHA-1."""
    return F.left(F.sha1(c), F.lit(16))


def safe_name(c: Column) -> Column:
    """A key as the name of a file or folder."""
    return F.replace(c, F.lit("/"), F.lit("__"))


def iso_time(c: Column) -> Column:
    """An instant as ISO text in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(c, F.expr("current_timezone()")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def duration(seconds: Column) -> Column:
    """Whole seconds as 1h05m, or 7m below an hour."""
    s = seconds.cast("bigint")
    h, m = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), F.lpad(m.cast("string"), 2, "0"), F.lit("m"))).otherwise(F.concat(m.cast("string"), F.lit("m")))


def archive_sha(root: Column) -> Column:
    """The commit at the end of the root folder's name of a repository's archive, '' if there is none."""
    return F.regexp_extract(root, r"^.+-([0-9a-f]{7,40})$", 1)


def share(part: Column, whole: Column) -> Column:
    """Percent, 0 of nothing."""
    return 100.0 * part / F.greatest(whole, F.lit(1))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def pair_hash(before: Column, after: Column) -> Column:
    return F.sha2(F.concat(text_of(before), F.lit("\x00\x01\x02"), text_of(after)), 256)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """The directory a path lies in, '' at the root."""
    return F.coalesce(F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2), F.lit(""))


def repo_slug(url: Column) -> Column:
    """owner/name of a repository address or slug."""
    return F.regexp_replace(F.regexp_extract(strip(url), r"(?:github\.com[/:])?([\w.-]+/[\w.-]+?)(?:\.git)?/?\z", 1), r"\.git\z", "")


def cursor_rule(path: Column) -> Column:
    """Whether a path holds an editor rule: a .cursorrules file, or a .mdc or .md file below .cursor/rules."""
    base, parts = F.lower(basename(path)), F.split(F.lower(path), "/")
    dirs = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    return (
        (base == ".cursorrules")
        | base.rlike(r"^\.cursorrules.*\.(md|txt|mdx)$")
        | (F.array_contains(dirs, ".cursor") & F.array_contains(dirs, "rules") & base.rlike(r"\.(mdc|md)$"))
    )


def cursor_rule_found(path: Column) -> Column:
    """The looser rule of searches: any .mdc file, any name that begins with .cursorrules, .md files of .cursor/rules."""
    p = F.lower(path)
    return F.lower(basename(path)).startswith(".cursorrules") | (p.contains(".cursor/rules/") & p.rlike(r"\.(mdc|md)$")) | p.endswith(".mdc")


def rule_name(path: Column) -> Column:
    """The name of an editor rule by its path."""
    base = basename(path)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    dotted = F.regexp_replace(stem, r"^\.+", "")
    root = F.lit("cursorrules-root")
    return F.when(F.lower(base) == ".cursorrules", root).when(F.lower(base).startswith(".cursorrules"), F.coalesce(F.nullif(dotted, F.lit("")), root)).otherwise(stem)


def outer_fence_removed(c: Column) -> Column:
    """A model's answer without the code fence around it."""
    s = strip(c)
    lines = F.split(s, "\n")
    inner = F.slice(lines, F.lit(2), F.size(lines) - F.when(strip(F.element_at(lines, -1)) == "```", 2).otherwise(1))
    return F.when(s.startswith("```") & (F.size(lines) > 1), F.array_join(inner, "\n")).otherwise(s)
