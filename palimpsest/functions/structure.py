"""Markdown structure of a revision and what an edit did to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import body, code_blocks, frontmatter, headings, strip, text_of

NAME = r"(?m)^name\s*:\s*(.+?)\s*$"
#: A description runs on over lines that do not begin with a word character.
DESCRIPTION = r"(?ms)^description\s*:\s*(.+?)(?=\n\w|\n---|\z)"


def parse_skill(c: Column) -> Column:
    """struct(frontmatter, body, name, description, headings, code_blocks)."""
    c = text_of(c)
    fm, rest = frontmatter(c), body(c)
    return F.struct(
        strip(fm).alias("frontmatter"), strip(rest).alias("body"), strip(F.regexp_extract(fm, NAME, 1)).alias("name"),
        strip(F.regexp_extract(fm, DESCRIPTION, 1)).alias("description"), headings(rest).alias("headings"), code_blocks(rest).alias("code_blocks"),
    )


def diff_summary(before: Column, after: Column, b: Column, a: Column) -> Column:
    """What changed from the parsed b to the parsed a."""
    added, removed = (F.array_sort(F.array_except(x["headings"], y["headings"])) for x, y in ((a, b), (b, a)))
    fm, text = ~b["frontmatter"].eqNullSafe(a["frontmatter"]), ~b["body"].eqNullSafe(a["body"])
    grown = F.length(a["body"]) - F.length(b["body"])
    none = text_of(before) == ""
    gone = text_of(after) == ""
    kind = (
        F.when(none & ~gone, "addition").when(~none & gone, "deletion").when(~(fm | text), "trivial").when(fm & ~text, "frontmatter_only")
        .when(text & ~fm & ((F.size(added) > 0) | (F.size(removed) > 0)), "structural")
        .when(text & ~fm & (a["code_blocks"] != b["code_blocks"]), "code_only").when(text & ~fm, "body_only").otherwise("both")
    )
    return F.struct(
        fm.alias("frontmatter_changed"), (a["name"] != b["name"]).alias("frontmatter_name_changed"),
        (a["description"] != b["description"]).alias("frontmatter_description_changed"),
        F.greatest(F.lit(0), grown).cast("int").alias("body_added_chars"), F.greatest(F.lit(0), -grown).cast("int").alias("body_removed_chars"),
        b["code_blocks"].alias("code_blocks_before"), a["code_blocks"].alias("code_blocks_after"),
        added.alias("sections_added"), removed.alias("sections_removed"), kind.alias("edit_kind"),
    )
