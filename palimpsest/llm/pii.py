"""Problem 1: personal information inside free text.

Method: a character-level bidirectional LSTM with CRF transitions (tagger.py), trained in numpy from labelled spans
(pii_train.py). A line is cut into overlapping windows; where windows overlap their scores are joined, each character taking
them from the window in which it stands further from an edge, and one path is decoded over the whole line. Found spans pass an
exact check of their kind (an address of a documented host is nobody's, a phone has digits enough) and are replaced by typed
placeholders.

Names are told from titles and tools by words: of a name without credit (an author line, a mail address beside it) one word at
least is not common. Common are the words of WORDS, a part of the model that training writes; what stands in a text decides what is
found in it, never how often it stands elsewhere. Lines that hold nothing the checks would pass are not tagged (plausible): what
the gate asks for, the check of the kind asks for too. Equal lines are tagged once per batch and remembered.

Defined results: null and empty texts have no items; texts are scanned whole; of two spans that overlap the longer stays; line
numbers start at 1 and count line feeds; repeated deliveries count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palimpsest.llm.tagger import KINDS, PAD, TAGS, Tagger, codes

MODEL = str(Path(__file__).with_name("pii_model.npz"))
#: Common words that are nobody's name, written by pii_train.
WORDS = Path(__file__).with_name("pii_words.txt")
WINDOW, OVERLAP = 160, 48
#: Added to the scores of all item tags: rather a span too many, which the checks refuse, than one missed.
LEAN = 0.7
_WORD = re.compile(r"[^\W\d_]{2,}")
_DOT, _AT = re.compile(r"(?i)\bdot\b"), re.compile(r"(?i)\bat\b.*\w\s*\.\s*\w")
_DIGIT = re.compile(r"\d")
#: Small words of the sentence, other than those inside street lines.
_CUT = re.compile(r"(?<![^\W_])(?!(?:rue|des|del|der|den|dem|van|von|the|and|las|los|dos|das)(?![^\W_]))[a-zß-ÿ]{3,}(?![^\W_])")
#: What every address has; in a line, whatever stands beside it.
_SOME_NUMBER = re.compile(r"(?<!\w)\d{1,5}(?:-?[a-zA-Z])?(?![^\W_])")
_NUMBER, _CAPITAL = re.compile(r"(?<![^\s,.])\d{1,5}(?:-?[a-zA-Z])?(?![^\s,;.])"), re.compile(r"[^\W\d_a-zß-ÿ][^\W\d_]{2,}")
#: Words before the name of a person, whatever the name.
_CREDIT = re.compile(r"(?i)(?:[a-z]-by|\b(?:author|maintainer|reviewer))[\"']?\s*[:=]\s*[\"']?")


def fixed_words(path: str | Path = WORDS) -> set[str]:
    return set(Path(path).read_text(encoding="utf-8").split())


def _streetlike(line: str) -> bool:
    """Whether a number and a capitalised word stand together, as every address has them."""
    return bool(_DIGIT.search(line)) and any(_SOME_NUMBER.search(p) and _CAPITAL.search(p) for p in _CUT.split(line))


def plausible(line: str, common: set[str]) -> bool:
    """Whether a line may hold an item: the checks pass none in any other."""
    return (
        "@" in line or not common.issuperset(_WORD.findall(line)) or len(_DIGIT.findall(line)) >= 6 or bool(_DOT.search(line))
        or _streetlike(line) or bool(_AT.search(line)) or bool(_CREDIT.search(line))
    )


def _emissions(net: Tagger, lines: list[str], batch: int = 1024) -> list[np.ndarray]:
    """Scores of every line, windows joined."""
    out = [np.empty((len(x), TAGS), np.float32) for x in lines]
    jobs = []  # (length, line, begin, from, to)
    for i, x in enumerate(lines):
        n = len(x)
        begins = [0] if n <= WINDOW else [*range(0, n - WINDOW, WINDOW - OVERLAP), n - WINDOW]
        for j, b in enumerate(begins):
            lo = 0 if j == 0 else (b + begins[j - 1] + WINDOW) // 2
            hi = n if j == len(begins) - 1 else (begins[j + 1] + b + WINDOW) // 2
            jobs.append((min(WINDOW, n - b), i, b, lo, hi))
    jobs.sort()
    sym = [codes(x) for x in lines]
    for k in range(0, len(jobs), batch):
        part = jobs[k : k + batch]
        size = part[-1][0]
        x = np.full((len(part), size), PAD, np.int16)
        for r, (n, i, b, _, _) in enumerate(part):
            x[r, :n] = sym[i][b : b + n]
        e = net.scores(x)
        for r, (_, i, b, lo, hi) in enumerate(part):
            out[i][lo:hi] = e[r, lo - b : hi - b]
    return out


_PLAIN_MAIL = re.compile(r"(?i)[a-z0-9][\w.+-]*@[a-z0-9-]+(?:\.[a-z0-9-]+)+")
_SPELLED = re.compile(r"(?i)[a-z0-9][\w.+-]*\s*[(\[{<]?\s*(?:@|\bat\b)\s*[)\]}>]?\s*[a-z0-9-]+(?:\s*(?:\.|[(\[{<]?\s*\bdot\b\s*[)\]}>]?)\s*[a-z0-9-]+)+")
_NOBODY = re.compile(r"(?i)no-?reply|do-?not-?reply|\.(?:example|invalid|test|localhost)$|[@.]example\.(?:com|org|net)$|^git@|^you@|^user@host")
_LEFT, _RIGHT = re.compile(r"[\w.+'’-]*$"), re.compile(r"^[\w+'’-]*(?:\.[\w-]+)*")


_NAME_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
#: Forms that are of one kind only; the tagger's mark yields to them.
_FORMS = ((re.compile(r"\d{2} \d{3} \d{3} \d{3}"), "id_number"), (re.compile(r"\d{3}[-.]\d{3}[-.]\d{4}"), "phone"))
#: Before the number of a place in a document, and after that of a server's answer.
_PLACE = re.compile(r"\b(?:Level|Chapter|Section|Part|Step|Page|Figure|Table|Appendix|Phase|Version|Issue|Item|Line|Rule) $")
_ANSWER = re.compile(r" (?:Not Found|Bad Request|Bad Gateway|Moved Permanently|Internal Server|Too Many|Service (?:Temporarily|Unavailable)|Gateway Time)")
#: Bare runs of digits are counts, times and keys, unless such a word stands shortly before.
_CALLED = re.compile(r"(?i)\b(?:tel|phone|call|mobile|cell|fax|sms|text|whatsapp|ring|handy|telefon|téléphone|teléfono)\b[^\d\n]{0,20}$")
_NUMBERED = re.compile(r"(?i)\b(?:ssn|social security|nino|national insurance|passport|tax|cpf|dni|nie|national id|identity|id card|personal|steuer-id|ausweis)\b[^\d\n]{0,20}$")
_MONTH = re.compile(r" (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\b")
#: Small words inside surnames.
_PARTICLES = frozenset("de da do dos del della di van von der den la le el al bin ten ter zu".split())
#: Between the words of one name.
_BETWEEN = re.compile(rf"[ .,]{{1,3}}(?:(?:{'|'.join(sorted(_PARTICLES))}) ){{0,3}}")


def _capital(w: str) -> bool:
    """Whether a word is written like a name: Sayed, al-Sayed, d'Arc."""
    return not w[0].islower() or bool(re.match(r"(?:al|el|d|l|o)['’-][^\W\d_a-zß-ÿ]", w))


def _names(line: str, s: int, e: int, common: set[str] | frozenset[str]) -> list[tuple[int, int]]:
    """The names in s:e, in which the tagger may have joined several with what stands between them."""
    # runs of words written alike: capitalised ones, or rare small ones; common small words end a run
    s, e = s - len(re.search(r"[^\W\d_'’-]*$", line[:s])[0]), e + len(re.match(r"[^\W\d_]*(?:['’-][^\W\d_]+)*", line[e:])[0])
    runs, last = [], ""
    for m in _NAME_WORD.finditer(line, s, e):
        w = m[0]
        how = "" if w in _PARTICLES and last == "C" else "C" if _capital(w) else "c" if w not in common else ""
        if how and how == last and _BETWEEN.fullmatch(line[runs[-1][-1].end() : m.start()]) and not (len(runs[-1][-1][0]) > 3 and ". " in line[runs[-1][-1].end() : m.start()]):
            runs[-1].append(m)
        elif how or not runs:
            runs.append([m])
        last = how or ("C" if w in _PARTICLES and last == "C" else "")
    out = []
    for run in runs:
        if len(run) == 1 and _capital(run[0][0]):  # the tagger may have marked one word of a name
            words = [m for m in _NAME_WORD.finditer(line, max(0, run[0].start() - 40), min(len(line), run[0].end() + 40)) if m[0] not in _PARTICLES]
            k = next((i for i, m in enumerate(words) if m.start() == run[0].start()), None)
            if k is not None:
                beside = lambda a, b: _BETWEEN.fullmatch(line[a.end() : b.start()]) and all(_capital(w[0]) and w[0] not in common and w[0].lower() not in common for w in (a, b))
                run = [*([words[k - 1]] if k and beside(words[k - 1], words[k]) else []), words[k], *([words[k + 1]] if k + 1 < len(words) and beside(words[k], words[k + 1]) else [])]
        words = [m[0] for m in run]
        rare = [w for w in words if len(w) > 2 and w not in common and not common.issuperset(w.lower().split("-"))]
        s, e = run[0].start(), run[-1].end()
        if 2 <= len(words) <= 5 and (rare or _credited(line, s, e)) and (words[0][0].isupper() or len(rare) == len(words)) and not any(c.isdigit() or c in "_@/$" for c in line[s:e] + line[s - 1 : s] + line[e : e + 1]):
            out.append((s, e))
    return out


def _credited(line: str, s: int, e: int) -> bool:
    """Whether s:e stands where only a person does."""
    credit = any(m.end() == s for m in _CREDIT.finditer(line)) or bool(re.match(r"\s*[<(]\s*[\w.+-]+@\w", line[e:]))
    return credit and not re.search(r"(?i)\b(?:team|bot|group|crew|project)$", line[s:e])


def _checked(line: str, s: int, e: int, kind: str, common: set[str] | frozenset[str]) -> list[tuple[int, int]]:
    """The exact spans of the items of a kind about s:e."""
    one = _names(line, s, e, common) if kind == "name" else _exact(line, s, e, kind)
    return one if isinstance(one, list) else [one] if one else []


def _exact(line: str, s: int, e: int, kind: str) -> tuple[int, int] | None:
    if kind == "email":
        for rx in (_PLAIN_MAIL, _SPELLED):
            for m in rx.finditer(line):
                if m.start() < e and m.end() > s:
                    token = line[: m.start()].rsplit(" ", 1)[-1]
                    if _NOBODY.search(m[0].rstrip(".")) or "://" in token or line[m.end() : m.end() + 2].startswith((":", "/")) and not line[m.end() : m.end() + 2].startswith(": "):
                        return None
                    if m.start() and line[m.start() - 1] in "@:/" and not token.endswith("mailto:"):
                        return None
                    return m.start(), m.end()
        return None
    while s < e and not (line[s].isalnum() or line[s] in "+("):
        s += 1
    while e > s and not (line[e - 1].isalnum() or line[e - 1] in ".)" and kind in ("name", "address", "phone")):
        e -= 1
    left, right = _LEFT.search(line[:s])[0], re.match(r"[^\W_]*", line[e:])[0]
    s, e = s - len(left.lstrip(".'’-+") if kind != "phone" else re.search(r"[+(]?\d*$", line[:s])[0]), e + len(right)
    text = line[s:e]
    digits, letters = sum(c.isdigit() for c in text), sum(c.isalpha() for c in text)
    beside = line[s - 1 : s] + line[e : e + 1]
    if kind == "phone":
        if not 7 <= digits <= 15 or letters or any(c.isalnum() or c in "_/" for c in beside):
            return None
        if re.fullmatch(r"\d{9,15}", text) and not _CALLED.search(line[:s]):
            return None
        return None if re.fullmatch(r"\d{4}-\d\d-\d\d|\d+\.\d+\.\d+\.\d+|\d{8}\.\d+|\d{4}-\d{4}", text) else (s, e)
    if kind == "id_number":
        if not 6 <= digits <= 16 or letters > 4 or re.search("[a-z]{3}", text) or any(c.isalnum() or c in "_/+=-" for c in beside) or letters and re.fullmatch("[0-9a-f]+", text):
            return None
        if re.match(r"\.\d", line[e:]):
            return None
        if re.fullmatch(r"\d{10}|\d{12,}", text) and not _NUMBERED.search(line[:s]):
            return None
        return None if re.fullmatch(r"\d{4}-\d\d-\d\d|\d{4}-\d{4}|[\d.]+\.\d+|[0-9a-f]{8}-[0-9a-f-]+", text) else (s, e)
    if kind == "address":
        if "@" in text:
            return None
        # small words of the sentence that the tagger took along part the span; the part with a number and a name stays
        cuts = list(_CUT.finditer(text))
        begins, ends = [0, *[m.end() for m in cuts]], [*[m.start() for m in cuts], len(text)]
        for b, e in zip(begins, ends, strict=True):
            part = text[b:e]
            numbers = (m for m in _NUMBER.finditer(part) if not _PLACE.search(line[: s + b + m.start()]) and not _ANSWER.match(line, s + b + m.end()) and not _MONTH.match(line, s + b + m.end()))
            if _CAPITAL.search(part) and any(numbers):
                return s + b + len(part) - len(part.lstrip(" ,;:")), s + b + len(part.rstrip(" ,;:"))
    return None


def _marked(net: Tagger, lines: list[str]) -> Iterator[tuple[int, list[tuple[int, int, str]]]]:
    """Every line that is not empty, by its index, with the spans (begin, end, kind) that the tagger marks."""
    order = sorted((i for i, x in enumerate(lines) if x), key=lambda i: -len(lines[i]))
    lean = np.zeros(TAGS, np.float32)
    lean[1:] = LEAN
    at = 0
    while at < len(order):
        # as many lines as keep the padded batch small
        size = max(1, 2_000_000 // (len(lines[order[at]]) + 1))
        part = order[at : at + min(size, 8192)]
        at += len(part)
        text = [lines[i] for i in part]
        paths = net.decode([e + lean for e in _emissions(net, text)])
        for i, x, path in zip(part, text, paths, strict=True):
            spans, b = [], 0
            while path.any() and b < len(x):
                if not path[b]:
                    b += 1
                    continue
                k = (path[b] - 1) // 2
                e = b + 1
                while e < len(x) and path[e] == 2 + 2 * k:
                    e += 1
                kind = next((as_kind for form, as_kind in _FORMS if form.fullmatch(x[b:e].strip(" .,;:()"))), KINDS[k])
                if kind == "name" and (m := _STREET.search(x, max(0, b - 8))) and m.start() < b < m.end():  # 7 N. Elm Drive
                    spans.append((m.start(), max(e, m.end()), "address"))
                else:
                    spans.append((b, e, kind))
                b = e
            yield i, spans


def find_in_lines(net: Tagger, lines: list[str], common: set[str] | frozenset[str] = frozenset()) -> list[list[tuple[int, int, str]]]:
    """The items (begin, end, kind) of every line, by the tagger; each begins where it is written, not where tagging began."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in lines]
    for i, marks in _marked(net, lines):
        spans = [(*c, kind) for b, e, kind in marks for c in _checked(lines[i], b, e, kind, common)]
        kept: list[tuple[int, int, str]] = []
        for s in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if all(s[1] <= o[0] or s[0] >= o[1] for o in kept):
                kept.append(s)
        out[i] = sorted(kept)
    return out


_HEADING = re.compile(r"#{1,6}\s")
_FENCE = re.compile(r"[ \t]*(`{3,}|~{3,})[ \t]*(\S*)")
#: Number and street as written in several countries.
_STREET = re.compile(
    r"\d{1,5}[a-zA-Z]?,? (?:[^\W\d_a-zß-ÿ][\w.'’-]* ){1,3}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Dr|Court|Terrace|Way|Gardens|Close|Mews|Boulevard|Blvd|Place|Square)\b"
    r"|\d{1,5},? (?:rue|avenue|boulevard|place|chemin) |\b(?:Calle|Via|Rua|Avenida) [^\W\d_a-zß-ÿ]|[^\W\d_](?:straße|strasse|weg|allee|gasse|platz|laan|straat|gracht) \d"
)


def _headings(lines: list[str]) -> Iterator[bool]:
    """Whether every line is a Markdown heading, which a line within a fence or a leading frontmatter block is not."""
    fence = "---" if lines[0].rstrip() == "---" and any(x.rstrip() == "---" for x in lines[1:]) else ""
    for n, x in enumerate(lines):
        yield not fence and bool(_HEADING.match(x))
        if fence == "---":
            if n and x.rstrip() == "---":
                fence = ""
        elif m := _FENCE.match(x):
            if not fence:
                fence = m[1]
            elif m[1][0] == fence[0] and len(m[1]) >= len(fence) and not m[2]:
                fence = ""


_nets: dict[str, Tagger] = {}


class Scanner:
    """Items of texts, line by line; remembers the lines it has met."""

    def __init__(self, net: Tagger, common: set[str], keep: int = 150_000):
        self.net, self.common, self.keep = net, common, keep
        self.known: dict[str, list] = {}

    def lines_of(self, texts: list[str | None]) -> list[list[str]]:
        """The lines of every text, all of them then known."""
        split = [(t or "").split("\n") for t in texts]
        if len(self.known) > self.keep:
            self.known.clear()
        new, known, common = [], self.known, self.common
        for lines in split:
            for x in lines:
                if x not in known:
                    known[x] = []
                    if plausible(x, common):
                        new.append(x)
        for x, spans in zip(new, find_in_lines(self.net, new, common), strict=True):
            known[x] = spans
        return split

    def items(self, lines: list[str]) -> Iterator[tuple[str, list]]:
        """The known lines of one text with their items: in headings, addresses need a street."""
        known = self.known
        if not any(x.startswith("#") and known[x] for x in lines):
            yield from ((x, known[x]) for x in lines)
            return
        for x, heading in zip(lines, _headings(lines), strict=True):
            yield x, [i for i in known[x] if i[2] != "address" or _STREET.search(x, i[0], i[1])] if heading else known[x]


def _net(model: bytes) -> Tagger:
    key = str(hash(model))
    if key not in _nets:
        _nets[key] = Tagger.load(model)
    return _nets[key]


def _scanner(model: bytes, common: set[str]) -> Scanner:
    return Scanner(_net(model), common)


def _parts(batch: pa.RecordBatch, size: int = 1000) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, size):
        yield batch.slice(i, size)


def scan(texts: DataFrame, columns: list[str], model: str = MODEL, words: str | Path = WORDS) -> DataFrame:
    """texts (columns, text) -> (columns, kind, line_no, begin, end): one row per item, places counted in characters of its line."""
    share = texts.sparkSession.sparkContext.broadcast
    common, raw = share(fixed_words(words)), share(Path(model).read_bytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(raw.value, common.value)
        for whole in batches:
            for batch in _parts(whole):
                rows, kinds, numbers, begins, ends = [], [], [], [], []
                for r, lines in enumerate(scanner.lines_of(batch["text"].to_pylist())):
                    for n, (_, items) in enumerate(scanner.items(lines), 1):
                        for b, e, k in items:
                            rows.append(r)
                            kinds.append(k)
                            numbers.append(n)
                            begins.append(b)
                            ends.append(e)
                take = pa.array(rows, pa.int64())
                extra = [pa.array(kinds, pa.string()), *(pa.array(c, pa.int64()) for c in (numbers, begins, ends))]
                yield pa.RecordBatch.from_arrays([*[batch[c].take(take) for c in columns], *extra], [*columns, "kind", "line_no", "begin", "end"])

    types = dict(texts.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", kind string, line_no bigint, begin bigint, end bigint"
    return texts.select(*columns, "text").mapInArrow(work, schema)


def redacted(texts: DataFrame, columns: list[str], model: str = MODEL, words: str | Path = WORDS) -> DataFrame:
    """texts (columns, text) -> (columns, text, items), every item replaced by [KIND]; the rest stays as it was."""
    share = texts.sparkSession.sparkContext.broadcast
    common, raw = share(fixed_words(words)), share(Path(model).read_bytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(raw.value, common.value)
        for whole in batches:
            for batch in _parts(whole):
                before = batch["text"].to_pylist()
                after, items = [], []
                for t, lines in zip(before, scanner.lines_of(before), strict=True):
                    n, out = 0, []
                    for x, spans in scanner.items(lines):
                        for b, e, k in reversed(spans):
                            x, n = f"{x[:b]}[{k.upper()}]{x[e:]}", n + 1
                        out.append(x)
                    after.append("\n".join(out) if t else t)
                    items.append(n)
                yield pa.RecordBatch.from_arrays([*[batch[c] for c in columns], pa.array(after, pa.string()), pa.array(items, pa.int64())], [*columns, "text", "items"])

    types = dict(texts.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", text string, items bigint"
    return texts.select(*columns, "text").mapInArrow(work, schema)
