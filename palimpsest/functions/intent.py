"""Intent of an edit by its commit subject and size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import text_of

# Types of conventional commits, and informal words with their class, in order of precedence.
TYPES = "feat|fix|docs|style|refactor|perf|test|build|ci|chore|revert"
INFORMAL = (
    (r"^\s*revert", "revert"),
    (r"^\s*merge\b", "merge"),
    (r"\binit(ial)?(\s+commit)?\b", "initial"),
    (r"\bfirst\s+commit\b", "initial"),
    (r"\b(typo|spelling)\b", "docs"),
    (r"\b(format|prettier|whitespace|lint)\b", "style"),
    (r"\b(rename|move|extract|inline)\b", "refactor"),
    (r"\b(bump|update\s+(deps?|dependencies))\b", "build"),
    (r"\b(readme|docs|comment)\b", "docs"),
    (r"\b(fix|bug|issue|error)\b", "fix"),
    (r"\b(add|new|implement|introduce|feature)\b", "feat"),
    (r"\b(improve|enhance|refine|polish|clean)\b", "refactor"),
    (r"\bwip\b", "chore"),
)
CONVENTIONAL = rf"(?i)^\s*({TYPES})(?:\([^)]+\))?\s*[:\-!]\s*"


def subject_class(subject: Column) -> Column:
    """struct(class, confidence) of a subject alone."""
    s = text_of(subject)
    kind = F.lower(F.regexp_extract(s, CONVENTIONAL, 1))
    as_struct = lambda c, conf: F.struct(c.alias("class"), F.lit(conf).cast("float").alias("confidence"))
    out = F.when(kind != "", as_struct(kind, 0.95))
    for pattern, name in INFORMAL:
        out = out.when(s.rlike("(?i)" + pattern), as_struct(F.lit(name), 0.65))
    return out.otherwise(as_struct(F.lit("unknown"), 0.0))


def intent(subject: Column, is_initial: Column, added: Column, removed: Column, delta: Column) -> Column:
    """struct(class, confidence): creation first, then no-op sizes, then the subject, then tiny edits of unknown subject."""
    s, zero = text_of(subject), F.lit(0)
    add, rem, size = F.coalesce(added, zero), F.coalesce(removed, zero), F.abs(F.coalesce(delta, zero))
    said = subject_class(subject)
    as_struct = lambda c, conf: F.struct(F.lit(c).alias("class"), F.lit(conf).cast("float").alias("confidence"))
    creation = F.coalesce(is_initial, F.lit(False)) & (rem == 0) & ((s == "") | F.lower(s).contains("init") | F.lower(s).contains("first"))
    return (
        F.when(creation, as_struct("initial", 0.95))
        .when((add == 0) & (rem == 0), as_struct("whitespace", 0.9))
        .when((add <= 1) & (rem <= 1) & (size < 30) & (said["class"] == "unknown"), as_struct("whitespace", 0.6))
        .otherwise(said)
    )
