"""Joins of revisions with their side tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seed_of(df: DataFrame, key: str, lists: Sequence[tuple[str, DataFrame]], other: str = "other") -> DataFrame:
    """Adds source_seed: the first of the named lists that has the key."""
    out = df
    for name, keys in lists:
        out = out.join(keys.select(F.col(keys.columns[0]).alias(key)).distinct().withColumn(f"__{name}", F.lit(True)), key, "left")
    seed = F.coalesce(*[F.when(F.col(f"__{n}"), F.lit(n)) for n, _ in lists], F.lit(other))
    return out.withColumn("source_seed", seed).drop(*[f"__{n}" for n, _ in lists])


def pending(wanted: DataFrame, journal: DataFrame, key: str, done: Sequence[str], failed: Sequence[str] | None = None, retry: bool = True) -> DataFrame:
    """Keys of wanted that the journal of latest entries (key, status) leaves to be done: those of a status in done never; those
    that failed only with retry. failed: the statuses that count as such, or None for all but done, so that whatever the journal
    has an entry for is not done again without retry."""
    blocks = F.col("status").isin(*done)
    if not retry:
        blocks = F.lit(True) if failed is None else blocks | F.col("status").isin(*failed)
    return wanted.join(journal.where(blocks), key, "left_anti")


def pull_requests(prs: DataFrame, repo: str, number: str, merge_sha: str, head_sha: str, columns: Sequence[str]) -> DataFrame:
    """(repo, sha, columns, pr_match_kind): one row per commit that a pull request names. Earlier requests win, and within one
    the merge commit wins over the head."""
    kinds = F.explode(
        F.array(
            F.struct(F.lit(0).alias("k"), F.col(merge_sha).alias("sha"), F.lit("merge_commit_sha").alias("pr_match_kind")),
            F.struct(F.lit(1).alias("k"), F.col(head_sha).alias("sha"), F.lit("head_sha").alias("pr_match_kind")),
        )
    )
    rows = prs.select(repo, number, *columns, kinds.alias("m")).where("m.sha is not null and m.sha <> ''")
    keep = [*dict.fromkeys([number, *columns])]
    best = rows.groupBy(repo, F.col("m.sha").alias("sha")).agg(
        F.min_by(F.struct(*keep, F.col("m.pr_match_kind").alias("pr_match_kind")), F.struct(number, F.col("m.k"))).alias("r")
    )
    return best.select(repo, "sha", *[F.col("r").getField(c).alias(c) for c in [*keep, "pr_match_kind"]])


def below_directory(
    files: DataFrame, path: str, dirs: DataFrame, directory: str, group: Sequence[str] = (), own: str | None = None, order: str | None = None
) -> DataFrame:
    """Files joined with the first directory (by order, or by name) that holds them, in place of a join on prefixes: every file
    lists the directories above it and meets them by equality. The root directory '' holds only files that lie at the root. own: a
    column of dirs with the path of a file that the directory's own row stands for, which it does not hold."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    above = F.when(F.size(parts) > 1, above).otherwise(F.array(F.lit("")))
    rows = files.withColumn("__dir", F.explode(above)).join(dirs.withColumn("__dir", F.col(directory)), ["__dir", *group])
    if own:
        rows = rows.where(~F.col(own).eqNullSafe(F.col(path)))
    mine = [*group, path]
    rest = [c for c in rows.columns if c not in (*mine, "__dir")]
    one = rows.groupBy(*mine).agg(F.min_by(F.struct(*rest), F.struct(*([order] if order else []), "__dir")).alias("r"))
    return one.select(*mine, *[F.col("r").getField(c).alias(c) for c in rest])


def with_clusters(df: DataFrame, clusters: DataFrame, key: str, cluster: str, canonical: str, self_default: bool) -> DataFrame:
    """Adds the cluster and canonical flag of a map (key, cluster, canonical). What the map lacks has no cluster: with
    self_default '' and stands for itself (canonical), else both are null."""
    known = clusters.select(key, cluster, canonical)
    out = df.drop(cluster, canonical).join(known, key, "left")
    if not self_default:
        return out
    return out.withColumns({canonical: F.coalesce(canonical, F.lit(True)), cluster: F.coalesce(cluster, F.lit(""))})


def shard_counts(rows: DataFrame, clean: DataFrame, shard: str) -> DataFrame:
    """(shard, n_records, n_clean): rows per shard (such as _metadata.file_name, or a key made a file name), and of those the ones
    that came through cleaning, 0 where none did."""
    all_rows = rows.groupBy(shard).agg(F.count("*").alias("n_records"))
    some = clean.groupBy(shard).agg(F.count("*").alias("n_clean"))
    return all_rows.join(some, shard, "left").withColumn("n_clean", F.coalesce("n_clean", F.lit(0)))


def known_keys(lists: Sequence[DataFrame], key: str) -> DataFrame:
    """The distinct keys of several lists."""
    out = lists[0].select(key)
    for x in lists[1:]:
        out = out.union(x.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def aligned_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both under the left schema: columns the right lacks are null, others it has are dropped, types follow the left."""
    have = set(right.columns)
    cols = [(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in left.dtypes]
    return left.union(right.select(*cols))


def left_wins(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key of the aligned union, of the left table where both have it."""
    return aligned_union(left, right.join(left.select(key), key, "left_anti"))


def relabel(df: DataFrame, labels: DataFrame, key: str, when: Column, columns: dict[str, Column]) -> DataFrame:
    """Replaces columns where a condition holds and labels (key, ...) has the key."""
    known = labels.withColumn("__hit", F.lit(True))
    out = df.join(known, key, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False)) & F.coalesce(when, F.lit(False))
    new = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in columns.items()}
    return out.withColumns(new).select(df.columns)
