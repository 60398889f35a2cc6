"""Revision histories of local git repositories as a Spark data source: format("githistory"), option("repos", "a,b")."""

from __future__ import annotations

import subprocess
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "repo string, skill_path string, skill_name string, before_sha string, after_sha string, before_content string, after_content string, commit_subject string,"
    " commit_author string, commit_email string, commit_date string, lines_added int, lines_removed int, char_delta int, is_initial boolean"
)
#: Between fields and between records of the log.
UNIT, RECORD = "\x1f", "\x1e"


#: What a first revision is compared with: the name git gives a tree without entries, a fixed value.
EMPTY_TREE = "4b825dc642cb6eb9a060e54bf8d69288fbee4904"


def numstat(text: str) -> tuple[int, int]:
    """Added and removed lines by the first line of a numstat; binary files count as none."""
    first = text.strip().split("\n", 1)[0].split("\t")
    return (int(first[0]), int(first[1])) if len(first) > 1 and first[0].isdigit() and first[1].isdigit() else (0, 0)


def log_records(text: str) -> list[list[str]]:
    """Records of exactly five fields; the last one, the subject, may hold the separator."""
    rows = (r.strip("\n").split(UNIT, 4) for r in text.split(RECORD))
    return [r for r in rows if len(r) == 5]


def is_skill(path: str) -> bool:
    return path.rsplit("/", 1)[-1].lower() == "skill.md"


def skill_name(path: str) -> str:
    """The folder's name, or the file's at the root."""
    *dirs, base = path.split("/")
    return dirs[-1] if dirs else base.rsplit(".", 1)[0]


def is_rule(path: str) -> bool:
    """An editor rule: a .cursorrules file, or a .mdc or .md file below .cursor/rules."""
    *dirs, base = path.lower().split("/")
    if base.startswith(".cursorrules"):
        return base == ".cursorrules" or base.endswith((".md", ".txt", ".mdx"))
    return ".cursor" in dirs and "rules" in dirs and base.endswith((".mdc", ".md"))


def rule_name(path: str) -> str:
    base = path.rsplit("/", 1)[-1]
    stem = base.rsplit(".", 1)[0] if "." in base[1:] else base
    if not base.lower().startswith(".cursorrules"):
        return stem
    return "cursorrules-root" if base.lower() == ".cursorrules" else stem.lstrip(".") or "cursorrules-root"


#: Kinds of files whose histories can be read: which paths, and what they are called. Others may be registered.
KINDS = {"skill_md": (is_skill, skill_name), "cursor": (is_rule, rule_name)}


class Repo(InputPartition):
    def __init__(self, path: str):
        self.path = path


class GitHistoryReader(DataSourceReader):
    def __init__(self, options):
        self.repos = [r for r in options.get("repos", "").split(",") if r]
        self.timeout = float(options.get("timeout", "1800"))
        kind = options.get("kind", "skill_md")
        if kind not in KINDS:
            raise ValueError(f"no such kind of file: {kind}")
        self.wanted, self.name = KINDS[kind]

    def partitions(self):
        return [Repo(r) for r in self.repos]

    def _git(self, until: float, repo: str, *args: str) -> bytes | None:
        left = until - time.monotonic()
        if left <= 0:
            raise TimeoutError(f"{repo}: not read within {self.timeout:g} s")
        run = subprocess.run(["git", "-c", "safe.directory=*", "-c", "core.quotePath=false", "-C", repo, *args], capture_output=True, timeout=left)
        return run.stdout if run.returncode == 0 else None

    def _must(self, until: float, repo: str, *args: str) -> str:
        out = self._git(until, repo, *args)
        if out is None:  # a repository that cannot be read is not an empty one
            raise RuntimeError(f"{repo}: git {args[0]} failed")
        return out.decode("utf-8", "replace")

    def read(self, partition: Repo) -> Iterator[tuple]:
        repo, until = partition.path, time.monotonic() + self.timeout
        for path in sorted(filter(self.wanted, self._must(until, repo, "ls-tree", "-r", "--name-only", "HEAD").splitlines())):
            log = self._must(until, repo, "log", "--follow", "--reverse", f"--format=%H{UNIT}%an{UNIT}%ae{UNIT}%aI{UNIT}%s{RECORD}", "--", path)
            sha0 = text0 = None
            for sha, author, mail, date, subject in log_records(log):
                blob = self._git(until, repo, "show", f"{sha}:{path}")
                try:
                    text = blob.decode("utf-8") if blob is not None else None
                except UnicodeDecodeError:
                    text = None
                if text is None:  # under another name then, or no text
                    continue
                added, removed = numstat(self._must(until, repo, "diff", "--numstat", sha0 or EMPTY_TREE, sha, "--", path))
                yield (repo, path, self.name(path), sha0, sha, text0, text, subject, author, mail, date, added, removed, len(text) - len(text0 or ""), sha0 is None)
                sha0, text0 = sha, text


class GitHistory(DataSource):
    """One partition per repository; a failed one is retried like any task, and leaves no half output. Options: repos, kind (of
    KINDS, skill_md by default) and timeout, in seconds for a whole repository."""

    @classmethod
    def name(cls) -> str:
        return "githistory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GitHistoryReader:
        return GitHistoryReader(self.options)


def register(spark) -> None:
    """Make format("githistory") known to a session."""
    spark.dataSource.register(GitHistory)
