"""Problem 6: template residue and error-page text.

Method: a regularised linear classifier on hashed n-grams of words and characters, length, place and title features, trained on
weak labels: lines that read like a response status, a script notice, an unfilled field or filler are positive, ordinary lines
and lines that mention such things are taken for negative. It judges every line that stands as content; a record is marked if one
of its lines is. Fenced and inline code, quotes and commands' fields are not content and are left out before.

The weak labels name some residue only, so the classifier must know more than they do. Positives are learned from twice, once
without the phrase that labelled them, so that what stands around it carries weight too. And a line without a label is no proof:
FOLDS models, each fitted without one part of the lines (lines alike but for digits and marks lie in one part), judge the part they
have not seen; unlabelled lines they take for residue are not learned from as negatives. So lines that no phrase names can be marked.

The training lines are a bounded sample (SAMPLE of each label, chosen by hash over all records); every line of every record is
judged. Records of held-out hosts (repositories) take no part in the fit that gives the validation figures. After a first fit all
lines are judged once, and the negatives that come too near (again SAMPLE by hash) join the training lines of the second.

Defined results: null, empty and blank texts are unmarked; repeated deliveries count once; with no positive line to learn from
nothing is marked; texts are judged whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.shingles import mix
from palimpsest.session import materialize, release

SAMPLE = 12_000
#: What a positive line weighs in training, and the score above which a negative line is learned from again.
POSITIVE, MARGIN = 6.0, -2.0
BITS = 17
HELD_OUT = 5  # one in so many hosts
FOLDS = 6
#: The upper bits of a line's hash by which the sample is cut: what is sorted are that many counts.
CUT = 16

#: What a line is made of that stands for content that is missing; fixed phrases of pages, servers and templates.
STATUS = re.compile(
    r"(?i)^(?:<[^<>]+>\s*)*(?:http/\d\S* )?(?:error )?[45]\d\d\b[\s:.–-]+(?:not found|forbidden|unauthori[sz]ed|bad g|bad r|service|internal|gateway|too many|access|the |error|page|moved)"
    r"|^(?:<[^<>]+>\s*)*(?:access denied|forbidden|not found|page not found|bad gateway|service unavailable|internal server error|gateway time-?out|too many requests|unauthori[sz]ed)\W*(?:\(\d+\))?\W*(?:</\w+>)*$"
    r"|\"status(?:code)?\": ?\"?[45]\d\d|<error><code>|<title>[^<]*(?:[45]\d\d|not found|denied|just a moment|error)|<h1>[^<]*(?:[45]\d\d|not found|denied)|<hr><center>|^request id: \S+$"
    r"|the (?:requested )?(?:page|url|file)\b.*(?:not found|does not exist|no longer exists|has been moved|was not found)|the page you (?:were|are) looking for|you do not have permission to (?:view|access)|your session has expired|^sign in to continue|^log ?in to continue|^please (?:log|sign) in\b.*\bview"
    r"|an unexpected error occurred|^oops\b|something went wrong\W*$|could not be (?:found|loaded)\b|did not answer in time|temporarily unavailable|^please try again (?:in|later)|\bback to home\b|rate limit exceeded\W*$|error code [0-9a-f]{6,}"
    r"|seite nicht gefunden|angeforderte seite|zugriff verweigert|page (?:introuvable|non trouvée)|la page demandée|accès refusé|página no encontrada|la página solicitada|acceso denegado|页面(?:不存在|未找到)|找不到页面|访问被拒绝|无法找到|ページが見つかりません|アクセスが拒否"
)
SCRIPT = re.compile(
    r"(?i)<noscript|requires? javascript\b|(?:enable|turn on|activate|allow) javascript|without javascript|javascript (?:is|must be|has been) (?:disabled|required|enabled|turned)|blocking scripts|checking your browser|<div id=\"(?:root|app)\"></div>|verify (?:that )?you are (?:a )?human|enable cookies|cookies (?:are|must be)|javascript aktivieren|activer javascript|activez javascript|active javascript|habilite javascript|启用 ?javascript|javascript ?を有効"
)
FIELD = re.compile(
    r"\{\{[^{}]*\}\}|\{%[^{}]*%\}|<%[^<>]*%>|%[A-Z][A-Z0-9_]{2,}%|(?<!\w)__[A-Z][A-Z_]{2,}__(?!\w)|\$\{[A-Za-z_][\w.]*\}|\[[A-Z]{3,}(?:[ _][A-Z]+)*\](?!\(|:)"
    r"|(?i:<(?:your|insert|add|enter|describe|replace|todo|name of|put)\b[^<>]*>|\[(?:your|insert|add|enter|describe|replace|todo|name of|tool name|purpose|put|write|fill)\b[^\]]*\](?!\())"
)
FILLER = re.compile(
    r"(?i)^[\W_]*(?:todo|tbd|fixme|tbc|xxx)\b(?:\W|$)|^xxx .* xxx$|lorem ipsum|dolor sit amet|consectetur adipiscing|\bgoes here\b|^[\W_]*replace this\b|^[\W_]*(?:write|add) (?:one|a few|your|some)\b.*\b(?:sentences?|description|text|content)\b|^[\W_]*brief description of|coming soon\W*$|under construction\W*$|placeholder text|^[\W_]*(?:sample|dummy|example) text\W*$|asdf|blah blah|^[\W_]*(?:undefined|null|nan|none|n/a|\[object object\]|loading)\W*$|^[\W_]*(?:your|insert) .{2,40} here\W*$|text missing"
    r"|(?:\b(?:lorem|ipsum|dolor|amet|aliqua|tempor|incididunt|labore|magna|veniam|nostrud|ullamco|nisi|aliquip|commodo|consequat|duis|aute|irure|reprehenderit|voluptate|velit|esse|cillum|fugiat|nulla|pariatur|excepteur|eiusmod|minim|adipiscing|consectetur|sed|sit|elit|do|et|ut|ex|ea|ad|in|id)\b\W*){6}"
)
#: Without one of these no pattern above can match; looked for first.
_GATE = ahocorasick.Automaton()
for _g in (
    "error |error:|error>|404|403|401|400|408|410|429|500|501|502|503|504|not found|forbidden|denied|unavailable|gateway|too many|unauthori|request id|<title|<h1|<hr|requested|permission to|session has|sign in|log in|login to|looking for|oops|went wrong|could not be|in time|try again|back to home|rate limit"
    "|seite|zugriff|introuvable|non trouv|demand|accès|no encontrada|solicitada|acceso|页面|找不到|访问|无法|ページ|アクセス|javascript|blocking scripts|noscript|your browser|id=\"root|id=\"app|human|cookie|{{|{%|<%|%|__|${|[|<your|<insert|<add|<enter|<describe|<replace|<todo|<name|<put"
    "|todo|tbd|fixme|tbc|xxx|lorem|dolor|goes here|replace this|sentence|description|content|brief|soon|construction|placeholder|sample text|dummy text|example text|asdf|blah|undefined|null|nan|none|n/a|loading|here|missing|amet|aliqua|magna|nulla|esse|velit|4xx|5xx|no longer|was not|does not exist|deleted|moved"
).split("|"):
    _GATE.add_word(_g, 1)
_GATE.make_automaton()
#: Lines about such things: the hard negatives.
MENTION = re.compile(r"(?i)todo|lorem|placeholder|javascript|\b[45]\d\d\b|not found|denied|template|browser|permission|missing|fill|error|<[^>]+>|\[[^\]]+\]|\$[A-Z{]|%|_{2,}")

_FENCE = re.compile(r"[ \t]*(`{3,}|~{3,})")
_CODE = re.compile(r"``[^`]+``|`[^`\n]*`")
_KEY = re.compile(r"^([A-Za-z_-]{1,24}):\s+(?=\S)")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|\{\{|\}\}|\{%|%\}|\$\{|__|[^\w\s]|_")


def weak_label(line: str) -> bool:
    """Whether a content line reads like residue."""
    if next(_GATE.iter(line.lower()), None) is None:
        return False
    return bool(STATUS.search(line) or SCRIPT.search(line) or FIELD.search(line) or FILLER.search(line))


def _phrases(line: str) -> list[tuple[int, int]]:
    """Where the weak label's patterns match."""
    return [m.span() for rx in (STATUS, SCRIPT, FIELD, FILLER) for m in rx.finditer(line) if m.end() > m.start()]


def unnamed(line: str) -> str | None:
    """A positive line without the phrases that label it, if two words at least are left."""
    out = list(line)
    for b, e in _phrases(line):
        out[b:e] = "\u0002" * (e - b)
    rest = re.sub("\u0002+", " \u0002 ", "".join(out)).strip()
    return rest if len(re.findall(r"[^\W_]+", rest)) >= 2 else None


def family(line: str) -> str:
    """The first phrase that labels a positive line, without its digits."""
    return min((re.sub(r"[\W\d_]+", " ", line[b:e].lower()).strip()[:16] for b, e in _phrases(line)), default="")


def content_lines(text: str | None) -> Iterator[tuple[str, str]]:
    """(place, line) of the lines of a text that stand as content, without inline code; place: F frontmatter, T title, H heading,
    B body, W a body of less than four lines."""
    if not text:
        return
    lines = text.split("\n")
    end = 0
    if lines[0].rstrip() == "---":
        end = next((i for i in range(1, len(lines)) if lines[i].rstrip() == "---"), 0)
    few = sum(1 for x in lines[end:] if x.strip()) < 6
    fence = ""
    title = True
    for i, raw in enumerate(lines):
        if 0 < i < end:
            place = "F"
        elif i in (0, end) and end:
            continue
        else:
            m = _FENCE.match(raw)
            if m:
                if not fence:
                    fence = m[1][0]
                elif m[1][0] == fence:
                    fence = ""
                continue
            if fence or raw.startswith(("    ", "\t", ">")):
                continue
            place = "W" if few else "B"
        x = _CODE.sub(" \u0001 ", raw).strip()
        if not x or x == "\u0001":
            continue
        if place == "F":
            x = _KEY.sub("", x).strip("'\"")
        elif x.startswith("#"):
            place, title = ("T" if title else "H"), False
        if x:
            yield place, x


class _Hash(dict):
    def __missing__(self, gram: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[gram] = xxhash.xxh3_64_intdigest(gram)
        return h


_hash = _Hash()
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(items: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of content lines (place, line), and the line each belongs to: words, pairs and triples of them, four
    characters running where there are few words, place, length, and place with length."""
    ids, owner, extra, extra_owner, chars, char_owner = [], [], [], [], [], []
    for i, (place, line) in enumerate(items):
        tokens = _TOKEN.findall(line.lower())
        n = len(tokens)
        ids.append(_hash["^"])
        ids.extend(map(_hash.__getitem__, tokens))
        ids.append(_hash["$"])
        owner.extend([i] * (n + 2))
        extra += (_hash[f"place {place}"], _hash[f"size {n.bit_length()}"], _hash[f"both {place} {min(n, 12)}"], _hash[f"case {line.isupper()} {line.islower()}"])
        extra_owner += (i, i, i, i)
        if n < 10:
            raw = f"^{line.lower()}$".encode()
            chars.append(raw)
            char_owner.extend([i] * len(raw))
    t, o = np.array(ids, np.uint64), np.array(owner, np.int64)
    out, who = [t, np.array(extra, np.uint64)], [o, np.array(extra_owner, np.int64)]
    two = o[:-1] == o[1:]
    out.append(mix(t[:-1] * _A + t[1:])[two])
    who.append(o[:-1][two])
    if len(t) > 2:
        three = o[:-2] == o[2:]
        out.append(mix(t[:-2] * _B + t[1:-1] * _A + t[2:])[three])
        who.append(o[:-2][three])
    if chars:
        c, co = np.frombuffer(b"".join(chars), np.uint8).astype(np.uint64), np.array(char_owner, np.int64)
        if len(c) > 3:
            four = co[:-3] == co[3:]
            out.append(mix((c[:-3] << np.uint64(24) | c[1:-2] << np.uint64(16) | c[2:-1] << np.uint64(8) | c[3:]) + _B)[four])
            who.append(co[:-3][four])
    return (np.concatenate(out) & np.uint64((1 << BITS) - 1)).astype(np.int64), np.concatenate(who)


def scores(w: np.ndarray, bias: float, items: list[tuple[str, str]]) -> np.ndarray:
    """The classifier's score of every line; above 0 it is residue."""
    if not items:
        return np.empty(0)
    f, o = features(items)
    return np.bincount(o, w[f], len(items)) + bias


def fit(rows: list[tuple[str, str, int]], epochs: int = 14, l2: float = 1e-5, rate: float = 0.3, batch: int = 256, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier, by batches with adaptive rates; a positive weighs as much as POSITIVE others."""
    w, bias = np.zeros(1 << BITS), -1.0
    if not rows or not any(y for *_, y in rows):
        return w, bias
    g2, b2 = np.full(1 << BITS, 1e-4), 1e-4
    y = np.array([r[2] for r in rows], float)
    weight = np.where(y > 0, POSITIVE, 1.0)
    f, o = features([r[:2] for r in rows])
    order = np.argsort(o, kind="stable")
    f, ends = f[order], np.searchsorted(o[order], np.arange(len(rows) + 1))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        perm = rng.permutation(len(rows))
        for k in range(0, len(perm), batch):
            part = perm[k : k + batch]
            fi = np.concatenate([f[ends[i] : ends[i + 1]] for i in part])
            oi = np.repeat(np.arange(len(part)), ends[part + 1] - ends[part])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(oi, w[fi], len(part)) + bias, -30, 30)))
            g = (p - y[part]) * weight[part]
            used, at = np.unique(fi, return_inverse=True)
            d = np.bincount(at, g[oi], len(used)) / len(part) + l2 * w[used]
            g2[used] += d * d
            w[used] -= rate * d / np.sqrt(g2[used])
            db = g.mean()
            b2 += db * db
            bias -= rate * db / b2**0.5
    return w, bias


def sample_lines(records: DataFrame, sample: int = SAMPLE, near: tuple[np.ndarray, float] | None = None) -> list[tuple[str, str, str, int]]:
    """records (host, text) -> (host, place, line, label): distinct content lines, at most sample of each class, the least by hash:
    positives, mentions and others; or with near (weights, bias) the negatives that score above MARGIN. Each task keeps the least
    of its own, so what is moved is bounded by tasks times sample."""
    share = records.sparkSession.sparkContext.broadcast(near)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, str], tuple[int, str, str]] = {}
        bar, counts, seen = [1 << 64] * 3, [0, 0, 0], set()
        for batch in batches:
            new = []
            for host, text in zip(batch["host"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for place, x in content_lines(text):
                    if x not in seen:
                        seen.add(x)
                        new.append((host, place, x))
            if len(seen) > 300_000:
                seen.clear()
            if share.value is not None:
                s = scores(*share.value, [n[1:] for n in new])
                new = [n for n, v in zip(new, s, strict=True) if v > MARGIN and not weak_label(n[2])]
            for host, place, x in new:
                h = xxhash.xxh3_64_intdigest(x)
                if h > max(bar):
                    continue
                c = 2 if share.value is not None else 0 if weak_label(x) else 1 if MENTION.search(x) else 2
                if h <= bar[c] and (c, x) not in kept:
                    kept[c, x] = (h, host, place)
                    counts[c] += 1
                    if counts[c] > 2 * sample:
                        bar[c] = sorted(v[0] for k, v in kept.items() if k[0] == c)[sample]
                        kept = {k: v for k, v in kept.items() if k[0] != c or v[0] <= bar[c]}
                        counts[c] = sum(1 for k in kept if k[0] == c)
        rows = [(c, x, h >> 1, host, place) for (c, x), (h, host, place) in kept.items()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = {"c": pa.int32(), "line": pa.string(), "h": pa.int64(), "host": pa.string(), "place": pa.string()}
        yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, t), v in zip(kinds.items(), cols, strict=True)})

    rows = records.select("host", "text").mapInArrow(least, "c int, line string, h bigint, host string, place string")
    rows = materialize(rows.groupBy("c", "line").agg(F.min("h").alias("h"), F.min("host").alias("host"), F.min("place").alias("place")))
    # hashes are even, so counts by their upper bits tell where to cut; no task sorts or holds the lines of all others
    counts: dict[int, dict[int, int]] = {}
    part = F.shiftright("h", 63 - CUT)
    for c, k, n in rows.groupBy("c", part.alias("k")).count().collect():
        counts.setdefault(c, {})[k] = n
    out: list[tuple[str, str, str, int]] = []
    for c, of in counts.items():
        total, last = 0, 0
        for last in sorted(of):
            total += of[last]
            if total >= sample:
                break
        some = sorted((r.h, r.line, r.host or "", r.place) for r in rows.where((F.col("c") == c) & (part <= last)).collect())
        out += [(host, place, line, int(c == 0)) for _, line, host, place in some[:sample]]
    release(rows)
    return sorted(out)


def held_out(host: str | None) -> bool:
    return xxhash.xxh3_64_intdigest("host " + (host or "")) % HELD_OUT == 0


Row = tuple[str, str, int]  # place, line, label


def _fold(line: str) -> int:
    return xxhash.xxh3_64_intdigest(re.sub(r"[\W\d_]+", " ", line.lower())) % FOLDS


def learn(rows: list[Row]) -> tuple[np.ndarray, float]:
    """The classifier by weakly labelled lines: with positives stripped of their phrases, without doubtful negatives."""
    rows = rows + [(place, rest, 1) for place, line, y in rows if y and (rest := unnamed(line))]
    folds = np.array([_fold(r[1]) for r in rows])
    if len(rows) < 10 * FOLDS:
        return fit(rows)
    doubtful = np.zeros(len(rows), bool)
    for f in range(FOLDS):
        mine = np.flatnonzero(folds == f)
        s = scores(*fit([rows[i] for i in np.flatnonzero(folds != f)]), [rows[i][:2] for i in mine])
        doubtful[mine] = s > 0
    return fit([r for r, d in zip(rows, doubtful, strict=True) if r[2] or not d])


def train(records: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, list[tuple[str, str, str, int]]]:
    """Weights, bias, and the lines (host, place, line, label) they were learned from."""
    rows = sample_lines(records, sample)
    rows += sample_lines(records, sample, fit([r[1:] for r in rows]))
    return *learn([r[1:] for r in rows]), rows


def validation(rows: list[tuple[str, str, str, int]]) -> dict[str, float]:
    """What learning from rows reaches: on hosts it has not seen, and on kinds of phrases that were taken out of the weak labels
    (every kind once; its lines are then neither positive nor negative)."""
    w, bias = learn([r[1:] for r in rows if not held_out(r[0])])
    test = [r for r in rows if held_out(r[0])]
    said = scores(w, bias, [r[1:3] for r in test]) > 0
    true = sum(r[3] for r in test)
    hit = sum(1 for s, r in zip(said, test, strict=True) if s and r[3])
    out = {"lines": len(rows), "held_out": len(test), "positive": true, "precision": hit / max(1, int(said.sum())), "recall": hit / max(1, true)}
    part = [xxhash.xxh3_64_intdigest("kind " + family(r[2])) % 5 if r[3] else -1 for r in rows]
    again = found = 0
    for k in range(5):
        gone = [r for r, p in zip(rows, part, strict=True) if p == k]
        if gone:
            w, bias = learn([r[1:] for r, p in zip(rows, part, strict=True) if p != k])
            found += int((scores(w, bias, [r[1:3] for r in gone]) > 0).sum())
            again += len(gone)
    return out | {"unnamed_kinds": again, "unnamed_recall": found / max(1, again)}


def mark(records: DataFrame, key: str, sample: int = SAMPLE) -> DataFrame:
    """records (key, host, text) -> (key, lines): how many content lines of each text are residue."""
    w, bias, _ = train(records, sample)
    share = records.sparkSession.sparkContext.broadcast((w.astype(np.float32), float(bias)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], bool] = {}
        for batch in batches:
            texts = [list(content_lines(t)) for t in batch["text"].to_pylist()]
            if len(known) > 300_000:
                known.clear()
            new = list({i for t in texts for i in t if i not in known})
            known.update(zip(new, (scores(*share.value, new) > 0).tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([batch[key], pa.array([sum(known[i] for i in t) for t in texts], pa.int64())], [key, "lines"])

    return records.select(key, "text").mapInArrow(work, f"`{key}` {dict(records.dtypes)[key]}, lines bigint")
