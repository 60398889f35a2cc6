"""Labelled spans for the tagger, and its training: python -m palimpsest.llm.pii_train DATA_DIR [LINES].

Spans come from two sources. Lines of a corpus are labelled by patterns and, for names, by a lexicon that is gathered from
credit lines and grown by the company its members keep; lines with rare words but without a label are the negatives. Composed
lines put random names, numbers and streets, in many spellings, into contexts of many kinds, so the tagger learns forms rather
than a list. The number of lines is bounded by LINES; nothing of this runs when texts are scanned.
"""

from __future__ import annotations

import random
import re
import sys
from collections import Counter
from collections.abc import Iterable
from pathlib import Path

import numpy as np

from palimpsest.llm.pii import MODEL, WORDS, plausible
from palimpsest.llm.tagger import KINDS, Tagger, codes, train

LINES = 24_000
_CAP = r"[^\W\d_a-zà-öø-ÿ][\w'’]+(?:-[^\W\d_a-zà-öø-ÿ][\w'’]+)?"
_CREDIT = re.compile(rf"(?:-by|[Nn]ame|[Aa]uthor|[Mm]aintainer|[Rr]eviewer)\"?: \"?({_CAP}) ((?:[A-Z]\. )?)({_CAP})")
_DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
EMAIL = re.compile(rf"(?<![\w.+/:@-])[A-Za-z0-9][\w.+-]*@{_DOMAIN}|(?<=mailto:)[\w.+-]+@{_DOMAIN}")
SPELLED = re.compile(r"(?i)(?<![\w.])[a-z0-9][\w.+-]* ?(?:\(at\)|\[at\]|\{at\}| at ) ?[a-z0-9-]+(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?[a-z0-9-]+)+")
PHONE = re.compile(
    r"(?<![\w./:-])(?:\+\d{1,3}[ .-]?(?:\(0\))?(?:\(?\d{1,5}\)?[ .-]?){1,5}\d{2,}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4}|0\d(?: \d\d){4}|0\d{3} \d{3} \d{3}|0\d{4} \d{6})(?![\w-])"
)
IDS = re.compile(
    r"(?<![\w./-])(?:\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]|\d{3}\.\d{3}\.\d{3}-\d{2}|X[A-Z]\d{7})(?![\w-])"
    r"|(?<![\w+ ])\d{2} \d{3} \d{3} \d{3}(?![\w ]*\d)|(?<=[,;])9\d{8}(?=\s*(?:[,;]|$))"
    r"|(?i:(?<=ssn )|(?<=ssn: )|(?<=ssn:)|(?<=security no\. )|(?<=security number: ))\d{9}(?!\w)|(?i:(?<=tax id )|(?<=tax number )|(?<=steuer-id ))\d{2} \d{3} \d{3} \d{3}"
)
_TOWN = r"[A-Z]\w+(?: [A-Z]{1,2}\d{1,2} \d[A-Z]{2}| \d{5})?"
ADDRESS = re.compile(
    rf"(?:Flat \d+, )?\d{{1,4}} (?:(?:North|South|East|West|[NSEW]\.?) )?[A-Z]\w+ (?:Street|St\.?|Road|Rd\.?|Avenue|Ave\.?|Lane|Drive|Dr\.?|Court|Terrace|Way|Gardens|Close|Mews|Boulevard|Blvd\.?|Place|Square)(?:, (?:Unit|Apt|Suite) \d+)?(?:, {_TOWN})?"
    rf"|\d{{1,4}},? rue (?:du|de la|des|de) [A-Z]\w+(?:, \d{{5}} [A-Z]\w+)?|Calle [A-Z]\w+ \d+(?:, \d+\.º [A-Z])?(?:, \d{{5}} [A-Z]\w+)?|[A-Z]\w+(?:straße|strasse|weg|allee) \d+\w?(?:, \d{{5}} [A-Z]\w+)?|[A-Z]\w+(?:laan|straat|gracht) \d+(?:-[a-z])?(?:, [A-Z]\w+)?"
)
_NOT_MAIL = re.compile(r"(?i)no-?reply|\.example$|@example\.|^git@|^you@")


def label(line: str, first: set[str], last: set[str], name_rx: re.Pattern) -> list[tuple[int, int, str]]:
    """Spans of a line by pattern and lexicon."""
    out = []
    for m in [*EMAIL.finditer(line), *SPELLED.finditer(line)]:
        if not _NOT_MAIL.search(m[0]) and "://" not in line[max(0, m.start() - 60) : m.start()].rsplit(" ", 1)[-1] and line[m.end() : m.end() + 1] not in (":", "/"):
            out.append((m.start(), m.end(), "email"))
    for rx, kind in ((ADDRESS, "address"), (IDS, "id_number"), (PHONE, "phone")):
        out += [(m.start(), m.end(), kind) for m in rx.finditer(line)]
    for m in name_rx.finditer(line):
        if not m["i"] or m["s"].lower() in last:
            out.append((m.start(), m.end(), "name"))
    keep: list[tuple[int, int, str]] = []
    for s in sorted(out, key=lambda s: (-(s[1] - s[0]), s[0])):
        if all(s[1] <= k[0] or s[0] >= k[1] for k in keep):
            keep.append(s)
    return sorted(keep)


def lexicon(lines: list[str], common: set[str]) -> tuple[set[str], set[str], re.Pattern]:
    """First and last names met in credits, and those met beside them."""
    first, last = set(), set()
    for x in lines:
        for m in _CREDIT.finditer(x):
            first.add(m[1].lower())
            last.update([m[3].lower()])
    for _ in range(3):
        f = "|".join(sorted(map(re.escape, first), key=len, reverse=True))
        g = "|".join(sorted(map(re.escape, last), key=len, reverse=True))
        after, before = re.compile(rf"\b(?i:{f}) (?:[A-Z]\. )?({_CAP})"), re.compile(rf"({_CAP}) (?:[A-Z]\. )?\b(?i:{g})\b")
        for x in lines:
            last.update(m[1].lower() for m in after.finditer(x) if m[1].lower() not in common and m[1] not in common)
            first.update(m[1].lower() for m in before.finditer(x) if m[1].lower() not in common and m[1] not in common and len(m[1]) > 2)
    f = "|".join(sorted(map(re.escape, first), key=len, reverse=True))
    g = "|".join(sorted(map(re.escape, last), key=len, reverse=True))
    rx = re.compile(rf"\b(?P<i>)(?i:{f}),? (?:[A-Z]\. ?)?(?P<s>(?i:{g})(?:-(?i:{g}))?)\b|\b(?i:{g}), (?i:{f})\b|\b[A-Z]\. ?(?:[A-Z]\. ?)?(?i:{g})(?:-(?i:{g}))?\b")
    return first, last, rx


# Composed lines. Random syllables, so no list of names can be learned from them.
_ON = "b br c cr d dr f fr g gr h j k kr l m n p pr qu r s st sv t th tr v w y z".split()
_NU, _CO = "a e i o u ai ei ia ö é".split(), "l m n r s t nd rk ll ss lm nn rt".split()
_ENDS = "son sen ez ova ski sky ich er mann berg stein ini ano escu aki ura oto ide wick ham ton dale mark ström holt etti kwe nen dze vic anda".split()


def _syll(r: random.Random, n: int) -> str:
    return "".join(r.choice(_ON) + r.choice(_NU) + (r.choice(_CO) if r.random() < 0.5 else "") for _ in range(n))


def _name(r: random.Random, lex) -> str:
    pick = lambda k, n: r.choice(lex[k]).title() if lex and r.random() < 0.6 else _syll(r, n).title()
    first = pick(0, r.choice([1, 2, 2, 3]))
    last = r.choice(lex[1]).title() if lex and r.random() < 0.5 else (_syll(r, r.choice([1, 2])) + r.choice(_ENDS)).title()
    if r.random() < 0.08:
        last += "-" + (_syll(r, 1) + r.choice(_ENDS)).title()
    if r.random() < 0.12:
        last = r.choice(["van der ", "van ", "de ", "da ", "del ", "von ", "al-", "el-", "bin ", "O'", "D'", "Mc"]) + last
    if r.random() < 0.06:
        first += " " + _syll(r, r.choice([1, 2])).title()
    k = r.random()
    out = f"{first} {last}" if k < 0.62 else f"{first[0]}. {last}" if k < 0.78 else f"{last}, {first}" if k < 0.86 else f"{first} {r.choice('ABCDEFGHKLMST')}. {last}"
    return out.lower() if r.random() < 0.08 else out.upper() if r.random() < 0.03 else out


def _mail(r: random.Random, lex) -> str:
    a, b = (_name(r, lex).lower().replace(".", "").replace(",", "").split() + ["x"])[:2]
    user = r.choice([f"{a}.{b}", f"{a[0]}{b}", f"{b}{r.randint(1, 99)}", f"{a}_{b}", f"{a[0]}.{b}", a, f"{a}.{b}+{_syll(r, 2)}"])
    host = [_syll(r, 2) + r.choice(["labs", "soft", "net", "hub", "data", "works", ""]), r.choice("com org net io de fr corp home intra internal lan co.uk".split())]
    if r.random() < 0.2:
        host.insert(0, r.choice(["mail", "eu", "ops", "dev"]))
    if r.random() < 0.25:
        at, dot = r.choice([(" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" AT ", " DOT "), ("(at)", "(dot)"), ("[at]", "[dot]")])
        return user + at + dot.join(host)
    out = f"{user}@{'.'.join(host)}"
    return out.upper() if r.random() < 0.06 else out


def _fill(r: random.Random, form: str) -> str:
    return "".join(str(r.randint(0, 9)) if c == "9" else r.choice("ABCDEFGHJKLMNPQRSTXYZ") if c == "A" else c for c in form)


_PHONES = "+44 99 9999 9999|+1 999 555 0199|+19995550199|(999) 555-0199|999-555-0199|999.555.0199|01 99 00 99 99|0491 570 999|07700 900999|+49 30 23125 999|+33 9 99 99 99 99|0099 99 999 9999|+61 9 9999 9999|+34 999 99 99 99|1-999-555-0199|020 7946 0999".split("|")
_IDS = "999-99-9999|999999999|QQ999999A|QQ 99 99 99 C|AA999999A|AA 99 99 99 A|9 99 99 99 999 999 99|999.999.999-99|XA9999999|99 999 999 999|99999999A|A9999999".split("|")
_WORDS_FOR_ID = "SSN|ssn:|social security no.|Social Security Number:|NI number|NINO|National Insurance no.|CPF|CPF nº|passport|passport no.|Passport number:|tax id|tax number|Steuer-ID|DNI|national id|ID card|personal no.|identity number".split("|")


def _address(r: random.Random) -> str:
    stem, town = _syll(r, r.choice([1, 2])).title() + r.choice(["field", "moor", "gate", "stone", "brook", "combe", ""]), _syll(r, 1).title() + r.choice(["ford", "haven", "mere", "wick", "val", "field"])
    n, k = r.randint(1, 480), r.randint(0, 8)
    if k == 0:
        return f"{n} {r.choice(['', 'East ', 'West ', 'S ', 'N. '])}{stem} {r.choice('Street Road Lane Drive Court Terrace Way Avenue'.split())}" + r.choice(["", f", {town}"])
    if k == 1:
        return f"Flat {r.randint(1, 30)}, {n} {stem} {r.choice('Gardens Close Mews'.split())}, {town} {_fill(r, 'QX9 9ZZ')}"
    if k == 2:
        return f"{n} {stem} {r.choice('St. Ave Rd Blvd Dr.'.split())}, {r.choice('Unit Apt Suite'.split())} {r.randint(1, 40)}, {town} {_fill(r, '99999')}"
    if k == 3:
        return f"{n} rue {r.choice(['du', 'de la', 'des'])} {stem}, {_fill(r, '99999')} {town}"
    if k == 4:
        return f"Calle {stem} {n}, {r.randint(1, 9)}.º {r.choice('ABC')}, {_fill(r, '99999')} {town}"
    if k == 5:
        return f"{stem}{r.choice(['straße', 'strasse', 'weg', 'allee'])} {n}, {_fill(r, '99999')} {town}"
    if k == 6:
        return f"{stem}{r.choice(['laan', 'straat'])} {n}-{r.choice('abc')}, {town}"
    if k == 7:
        return f"{r.choice(['Via', 'Piazza', 'Rua das', 'Rua de'])} {stem} {n}, {_fill(r, r.choice(['99999', '9999-999']))} {town}"
    return f"{n} {stem} {r.choice('Street Road Lane'.split())}"


_FORMS = """<N> asked for a <w> that can be paused.|Thanks to <N> for the <w> idea.|Reviewed-by: <N>|Co-authored-by: <N> <<E>>|author: <N> <<E>>|# maintainer: <N> <<E>>|- Name: <N>|- Mail: <E>|- Phone: <P>|Questions about the <w> go to <E>.|Write to <E> when the <w> breaks.|Ask <E> for access to the <w>.|cc <E>; <E>|The <w> owner can be reached by [mail](mailto:<E>).|<N>|<A>|Tested by <N> and <N> on the <w>.|On Tuesday <N> wrote that the <w> was <w>.|As <N> pointed out in the call, the <w> was <w>.|Pairing with <N> helped to find the <w>.|This follows the <w> that <N> drew on the board.|> <N>, <E>|- <N> (<E>)|<N> (<P>) owns the <w>.|<N> can be called on <P> about the <w>.|Call the duty phone <P> if the <w> stays red.|The <w> hotline is <P>.|Tel/SMS <P>|Outside hours use <P> and ask for the <w> shift.|Rückfragen bitte an <N>, Tel. <P>.|Pour le <w>, appeler <N> au <P>.|Dudas sobre <w>: <N>, tfno. <P>|The sample form had <J> <I> in the first <w>, please blank it.|A user named <N> sent <J> <I> and lives at <A>; mask all of that.|It choked on <J> <I>. Start with the <w>.|    <N>;<I>;<w>;17|42,<N>,<I>|<d>,<N>,<I>|<N>;<I>;<w>|It choked on <J> <I>.|A user sent <J> <I> and wrote to us.|  "customer": "<N>",|  "phone": "<P>",|  "street": "<A>"|  "email": "<E>",|  oncall: "<P>"|  contact: <E>|<!-- asked <N>, tel. <P>, about the <w> -->|# ask <N> before changing the <w>|// owner: <N> <<E>>|Ship the <w> to <A>.|The <w> stands at <A> for now.|Delivery note: <A>, ring <P> at the gate.|Invoices for the <w> are posted to <A>, please keep the receipt.|<w> team, <A>|Dr. <N> owns the <w>|Reported by <N>|Suggested-by: <N>|Contact <N> at <P> or <E>|Signed-off-by: <N> <<E>>|ping <N> on Monday|If nobody answers → <P> (voice) or <P> (text).|met with <N> about the <w>|Owner: <N>, <A>""".split("|") + ["| <w> owner | <E> |", "| <N> | <P> |", "| <w> | <N> | <E> |"]
_FILL = "route parser ledger index cache gateway schema draft session counter bridge matrix panel quiet stable remote".split()
_NEVER = """Commits by noreply@forge.example are made by the <w> bot.|Mail templates use support@example.com or you@<w>.example as the sender of the <w>.|Clone it with `git@forge.example:<w>/<w>.git` and pin `@<w>/<w>@2.1.7`.|Ask @<w>-<w> in the channel, handles are enough.|<T> reads the <w> and writes a <w> next to the <w>.|<T> and <T> share the <w>, so review both when the <w> changes.|Thanks to <T> the <w> is stable again; reviewed by the <w> team.|See Chapter 15, <W> <W>, for the <w>.|# <W> <W>|## <W> <W>|Range 10.<d>.0.0/16 and date 2024-08-0<d> are <w> values.|The checksum <d><d><d><d><d><d> and the epoch 17<d><d><d><d> must match the <w>.|Build 2025<d><d>.<d> took <d> ms; the <w> listens on ports 5433-5586.|postgres://svc<w>:<w><d>@host.internal:5432/<w>|scp <w>.tar <w>@host.lan:/srv/|curl -u svc-<w>:<w>9 https://<w>.home/<w>.tgz|version <d>.<d>.<d> of the <w>|2023-11-0<d>T07:29:18+02:00|id <d><d><d>-<d>|-----BEGIN <W> <W> KEY-----|-----END OPENSSH PRIVATE KEY-----|Oops! Something went wrong.|When the <w> answers 404 NOT Found, wait and try the <w>.|<d><d>.<d>.<d> FORBIDDEN <W>""".split("|") + ["| <w> | <d><d><d> |"]


def compose(r: random.Random, n: int, lex, tools: list[str]) -> list[tuple[str, list[tuple[int, int, str]]]]:
    out = []
    for _ in range(n):
        form = r.choice(_NEVER) if r.random() < 0.3 else r.choice(_FORMS)
        if r.random() < 0.12:  # several items with little between them
            form = r.choice(["", "Reach ", "- ", "see ", "Mail "]) + "".join(f"<{r.choice('NEPA')}>{r.choice([', ', '; ', ' | ', ' or ', ' / ', ' and ', ' - '])}" for _ in range(r.randint(1, 3))) + f"<{r.choice('NEPA')}>"
        elif r.random() < 0.1:
            form += " " + r.choice(_FORMS)
        text, spans, at = "", [], 0
        for m in re.finditer(r"<([NEPIAJwWTd])>", form):
            text += form[at : m.start()]
            at, k = m.end(), m[1]
            kind = {"N": "name", "E": "email", "P": "phone", "I": "id_number", "A": "address"}.get(k)
            v = {
                "N": lambda: _name(r, lex), "E": lambda: _mail(r, lex), "P": lambda: _fill(r, r.choice(_PHONES)), "I": lambda: _fill(r, r.choice(_IDS)),
                "A": lambda: _address(r), "J": lambda: r.choice(_WORDS_FOR_ID), "w": lambda: r.choice(_FILL), "W": lambda: r.choice(_FILL).title(),
                "T": lambda: r.choice(tools), "d": lambda: str(r.randint(1, 255)),
            }[k]()
            if kind:
                spans.append((len(text), len(text) + len(v), kind))
            text += v
        out.append((text + form[at:], spans))
    return out


def tags_of(n: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
    t = np.zeros(n, np.int64)
    for s, e, k in spans:
        i = 1 + 2 * KINDS.index(k)
        t[s], t[s + 1 : e] = i, i + 1
    return t


def common_words_of(texts: Iterable[str], rare: int = 1000) -> set[str]:
    """The words that stand in one of so many training texts at least."""
    n, count = 0, Counter()
    for t in texts:
        n += 1
        count.update(set(re.findall(r"[^\W\d_]{2,}", t)))
    return {w for w, c in count.items() if c * rare >= n}


def words_of(common: set[str], first: set[str], last: set[str]) -> list[str]:
    """The common words that no lexicon holds as part of a name."""
    return sorted(w for w in common if w.lower() not in first and w.lower() not in last)


def main(data: str, bound: int = LINES, hidden: int = 24, epochs: int = 10) -> None:
    import pyarrow.parquet as pq

    r = random.Random(11)
    table = pq.read_table(f"{data}/diffs.parquet", columns=["pr_body", "after_content"]).to_pydict()
    texts = [t for c in table.values() for t in c if t]
    common = common_words_of(texts)
    lines = sorted({x.rstrip("\r") for t in texts for x in t.split("\n")})
    kept = [x for x in lines if plausible(x, common)]
    print(len(lines), "lines,", len(kept), "plausible", sum(map(len, kept)), "characters;", len(common), "common words")
    first, last, rx = lexicon(kept, common)
    print(len(first), "first and", len(last), "last names", sorted(first)[:80])
    WORDS.write_text("\n".join(words_of(common, first, last)) + "\n", encoding="utf-8")
    marked = [(x, label(x, first, last, rx)) for x in kept]
    good = [m for m in marked if m[1]]
    rest = [m for m in marked if not m[1]]
    r.shuffle(good)
    r.shuffle(rest)
    rest.sort(key=lambda m: len(m[0]) > 240)
    tools = sorted({m[0] for x in rest for m in re.finditer(r"(?<=and )[A-Z][a-z]+ [A-Z][A-Za-z]+(?= share)", x[0])}) or ["Velvet Parser"]
    print(len(good), "with spans;", "tools", tools)
    test, good = good[: len(good) // 10], good[len(good) // 10 :]
    quiet, rest = rest[:800], rest[800:]
    rows = (good * 3)[: bound // 3] + rest[: bound // 4]
    lex = (sorted(first), sorted(last))
    rows += compose(r, bound // 3, lex, tools)
    print(len(rows), "lines to train on")
    net = train([codes(x) for x, _ in rows], [tags_of(len(x), s) for x, s in rows], hidden=hidden, epochs=epochs)
    Path(MODEL).write_bytes(net.dump())
    report(Tagger.load(Path(MODEL).read_bytes()), test + quiet, common)


def report(net: Tagger, rows, common=frozenset()) -> None:
    """Held-out spans found (by kind and begin) and spans too many."""
    from palimpsest.llm.pii import find_in_lines

    got = find_in_lines(net, [x for x, _ in rows], common)
    for kind in KINDS:
        want = {(i, s) for i, (_, spans) in enumerate(rows) for s, _, k in spans if k == kind}
        have = {(i, s) for i, spans in enumerate(got) for s, _, k in spans if k == kind}
        print(f"{kind}: {len(want)} spans, {len(want & have)} found, {len(have - want)} others")
        for i, s in list(want - have)[:4]:
            print("   missed", repr(rows[i][0][max(0, s - 40) : s + 60]))
        for i, s in list(have - want)[:4]:
            print("   other ", repr(rows[i][0][max(0, s - 40) : s + 60]))


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:]))
