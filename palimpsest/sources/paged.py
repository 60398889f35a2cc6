"""Paged services as a source: an injected function fetches a page, tasks page through, failures are told as a status."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fetch(key, page) -> (HTTP status, items of the page).
Fetch = Callable[[str, int], tuple[int, list[dict[str, Any]]]]
SCHEMA = "key string, status string, n_items int, items string"


def fetch_all(fetch: Fetch, key: str, max_pages: int = 20, page_size: int = 100, retries: int = 4, pause: float = 1.0) -> tuple[str, list[dict[str, Any]]]:
    """(status, items) of a key: ok, not_found or error. Rate limits and server errors are waited for, twice as long each time;
    a page that is not full is the last."""
    items: list[dict[str, Any]] = []
    for page in range(1, max_pages + 1):
        for attempt in range(retries + 1):
            code, got = fetch(key, page)
            if code not in (403, 429) and code < 500:
                break
            if attempt == retries:
                return "error", items
            time.sleep(pause * 2**attempt)
        if code == 404:
            return "not_found", []
        if code >= 400:
            return "error", items
        items += got
        if len(got) < page_size:
            break
    return "ok", items


def pages(keys: DataFrame, key: str, fetch: Fetch, **how) -> DataFrame:
    """(key, status, n_items, items as JSON) for every distinct non-null key."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *fetch_all(fetch, k, **how)) for k in batch["key"]]
            yield pd.DataFrame([(k, s, len(i), json.dumps(i)) for k, s, i in rows], columns=["key", "status", "n_items", "items"])

    return keys.select(F.col(key).cast("string").alias("key")).where("key is not null").distinct().mapInPandas(work, SCHEMA)


def search(queries: DataFrame, query: str, fetch: Fetch, most: int = 1000, page_size: int = 100, pause: float = 6.5, **how) -> DataFrame:
    """(key, status, n_items, items) of every distinct query of a search service that gives most results at most and wants a pause
    between pages. A query whose results reach that number has the status capped: it must be narrowed to be seen whole."""

    def slow(key: str, page: int) -> tuple[int, list[dict[str, Any]]]:
        if page > 1:
            time.sleep(pause)
        return fetch(key, page)

    got = pages(queries, query, slow, max_pages=-(-most // page_size), page_size=page_size, **how)
    return got.withColumn("status", F.when((F.col("status") == "ok") & (F.col("n_items") >= most), "capped").otherwise(F.col("status")))


def found_in(results: DataFrame, field: str, kind: str) -> DataFrame:
    """(found, kind, query): what a search found, by a field of its items, and by which query: where each came from."""
    item = F.explode(F.from_json("items", f"array<struct<`{field}`:string>>")).alias("i")
    return results.select(F.col("key").alias("query"), item).select(F.col(f"i.{field}").alias("found"), F.lit(kind).alias("kind"), "query").where("found is not null").distinct()


def pull_requests(results: DataFrame) -> DataFrame:
    """(repo, number, title, body, state, merged_at, merge_commit_sha, head_sha, html_url): the fields that count of the service's
    pull requests, which are nested documents with many more."""
    kind = "array<struct<number:int,title:string,body:string,state:string,merged_at:string,merge_commit_sha:string,head:struct<sha:string>,html_url:string>>"
    rows = results.where("status = 'ok'").select(F.col("key").alias("repo"), F.explode(F.from_json("items", kind)).alias("p"))
    return rows.select("repo", *[F.col(f"p.{c}").alias(c) for c in ("number", "title", "body", "state", "merged_at", "merge_commit_sha")], F.col("p.head.sha").alias("head_sha"), F.col("p.html_url").alias("html_url"))


def repository_facts(results: DataFrame, fetched_at: str) -> DataFrame:
    """(repo, license_spdx, license_name, stars, default_branch, pushed_at, fetched_at, fetch_status): one row per repository asked
    for; those that failed have their status and nulls."""
    kind = "array<struct<license:struct<spdx_id:string,name:string>,stargazers_count:int,default_branch:string,pushed_at:string>>"
    rows = results.select(F.col("key").alias("repo"), F.get(F.from_json("items", kind), F.lit(0)).alias("i"), F.col("status").alias("fetch_status"))
    return rows.select(
        "repo", F.col("i.license.spdx_id").alias("license_spdx"), F.col("i.license.name").alias("license_name"), F.col("i.stargazers_count").alias("stars"),
        F.col("i.default_branch").alias("default_branch"), F.col("i.pushed_at").alias("pushed_at"), F.lit(fetched_at).alias("fetched_at"), "fetch_status",
    )


def refreshed(held: DataFrame, keys: DataFrame, key: str, fetch: Fetch, retry_errors: bool = True, **how) -> DataFrame:
    """A cache (SCHEMA) completed by the keys it lacks, and, if asked for, by those that failed before."""
    done = held.where("status <> 'error'") if retry_errors else held
    wanted = keys.select(F.col(key).cast("string").alias("key")).distinct().join(done.select("key"), "key", "left_anti")
    return done.unionByName(pages(wanted, "key", fetch, **how))
