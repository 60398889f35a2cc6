"""Problem 2: credentials embedded in source code and configuration files.

Method: a text is read as a file of its format (by its name, or by the language of a fenced block) into entries of key path,
value and offsets; an entry is a credential if its key is named like one and its value has the shape of one; a key that says nothing by
itself (default, value, prod, a place in a list) has the name of what it stands in. YAML, JSON, TOML, INI, HCL and XML are read by
keypaths.py; lines of every text, also of these, are read by patterns for single assignments. Headers, logins in
addresses, command options and known token shapes count wherever they stand. A finding is the span of the value alone, and
redaction splices a mask over these spans of the original bytes, so quotes, indentation and line ends stay as they were.

Not credentials: references to variables, vaults and files, evident dummies, identifiers and digests, public keys, settings
about credentials (their length, lifetime, place).

Defined results: null, empty and binary files have no findings; a value that several rules find is one finding; exact repeats
of a record count once; line numbers start at 1 and count line feeds; texts are scanned whole, whatever their length.
"""

from __future__ import annotations

import base64
import binascii
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from palimpsest.llm import keypaths


class Finding(NamedTuple):
    start: int
    end: int
    kind: str
    key: str


#: Last words of a key that names a credential by itself, and what must stand before "key". Fixed values.
NAMES = frozenset("password passwd passphrase pwd pass pw passcode secret secrets token tokens credential credentials auth apikey authtoken bearer authorization".split())
KEYS = frozenset("api access secret private signing sign deploy encryption encrypt master auth service client account storage ssh webhook app admin shared hmac session license consumer subscription jwt".split())
#: Words that may follow without changing what the key means.
TAIL = frozenset("value val default b64 base64 encoded enc prod production staging dev test old new current primary secondary backup literal plain text string".split())
DUMMY = re.compile(
    r"(?i)change.?me|example|dummy|placeholder|\byour\b|your[-_ ]|redacted|insert|replace|x{4,}|\*{3,}|\.{3,}|todo|^<.*>$|^(none|null|nil|undefined|true|false|yes|no|on|off|test|testing|sample|fake|foo|bar|baz|secret|password|passwd|token|user|pass|admin|root|string|required|optional|hidden|masked|empty)\d{0,3}$|0123456|12345678|abcdef|not.?a.?real|^(.)\2+$"
)
REFERENCE = re.compile(
    r"^\$|^%\w+%$|^\{\{|^<%|^<[A-Za-z]|\$\{|\$\(|\{\{|\{%|^(?:process|os|env|ENV|secrets|vars?|config|settings|self|this|props)\b[.\[(]|getenv|environ|getpass|^(?:vault|op|ssm|aws-?sm|gcp-?sm|keyring|kms|sops|env|file|ref|secretref|keychain|arn|azure-?kv|akv)[:/]|^@|^ENC\[|^!|^(?:secret|kv)/|^/(?:run|etc|var|srv|home|opt|usr|mnt|secrets?)/|^~?\.{0,2}/[\w./-]+$|^[a-z]+://[^@]*$"
)
_KNOWN = (
    r"(?:sk|pk|rk)_(?:live|test)_[A-Za-z0-9]{16,}|sk-(?:[a-z]+-)?[A-Za-z0-9_-]{24,}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}"
    r"|npm_[A-Za-z0-9]{24,}|xox[abposr]-[A-Za-z0-9-]{12,}|(?:AKIA|ASIA)[A-Z0-9]{16}|AIza[A-Za-z0-9_-]{30,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|hf_[A-Za-z0-9]{24,}|pypi-[A-Za-z0-9_-]{32,}|dop_v1_[a-f0-9]{32,}|shp(?:at|ss|ca)_[a-fA-F0-9]{24,}|ya29\.[A-Za-z0-9_-]{20,}"
)
KNOWN = re.compile(rf"(?<![A-Za-z0-9_-])(?:{_KNOWN})(?![A-Za-z0-9])")
#: A prefix of letters and a long random part: the habit of services unknown here. The random part must be mixed.
PREFIXED = re.compile(r"(?<![A-Za-z0-9_./-])[a-z]{2,10}_(?=[A-Za-z0-9]*[a-z])(?=[A-Za-z0-9]*[A-Z])(?=[A-Za-z0-9]*[0-9])[A-Za-z0-9]{24,}(?![A-Za-z0-9_])")
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----(?:(?!-----BEGIN)[\s\S])*?-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----|-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
#: Where a credential may be, in lower case: lines without any of these, or of _TAILED, are not looked at. Fixed values.
TRIGGERS = (
    "passw passphrase passcode pwd pass pw secret token credential auth bearer key -p -u :// base64 b64 atob sk_live_ sk_test_ pk_live_ rk_live_ sk- ghp_ gho_ ghu_ ghs_ ghr_"
    " github_pat_ glpat- npm_ xoxa- xoxb- xoxo- xoxp- xoxs- xoxr- akia asia aiza sg. eyj hf_ pypi- dop_v1_ shpat_ shpss_ shpca_ ya29."
).split()
_TAILED = re.compile(r"_[A-Za-z0-9]{24}")
_finder = ahocorasick.Automaton()
for _word in [*TRIGGERS, "basic "]:
    _finder.add_word(_word, len(_word))
_finder.make_automaton()
_SLOW = re.compile("|".join(map(re.escape, [*TRIGGERS, "basic "])), re.I)
_WORTH = re.compile(r"""[0-9"'`=:$]""")
URL = re.compile(r"\b[a-zA-Z][a-zA-Z0-9+.-]*://([^\s/@:'\"`<>]*):([^\s/@'\"`<>]*(?:/[A-Za-z0-9+/=]*)*)@(?=[A-Za-z0-9$\[{])")
HEADER = re.compile(r"(?i)\b(bearer|basic|token|apikey|negotiate)\s+([A-Za-z0-9+/_=.~:$-]{6,})")
AUTHORIZATION = re.compile(r"(?i)\bauthorization\b")
OPTION = re.compile(r"""(?:\bsshpass\s+-p\s*|\s--?(?:password|passwd|pass|pwd|token|secret|api-key|apikey|auth-token|access-token|client-secret|secret-key|private-token)(?:=|\s+)|\bmysql\b[^|;\n]*\s-p(?=\S)|\bdocker login\b[^|;\n]*\s-p\s+)(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'`;|&)]+))""")
USER = re.compile(r"""\s(?:-u|--user)(?:=|\s+)(?:"[^":\s]*:([^"\n]+)"|'[^':\s]*:([^'\n]+)'|[^\s"':]+:["']?([^\s"'`;|&)]+))""")
NETRC = re.compile(r"""(?:^|\s)(?:password|passwd)\s+("?)([^\s"]+)\1""")
PROSE = re.compile(r"""(?i)\b(password|passwd|passphrase|passcode|pwd|token|secret|key|credential)s?\b(?:\s+(?:is|was|now))?\s*[:=]?\s*(?:`([^`\n]+)`|"([^"\n]+)"|'([^'\n]+)'|([^\s`"',;]+))""")
DECODED = re.compile(r"""(?i)(?:b64decode|atob|base64[._]?decode\w*|decodebase64|from_?base64|frombase64string|Buffer\.from)\(\s*b?["']([A-Za-z0-9+/=_-]{8,})["']|\becho\s+(?:-n\s+)?["']?([A-Za-z0-9+/=]{8,})["']?\s*\|\s*(?:openssl\s+)?base64\s+(?:-d|--decode|-D)""")
_QUOTED = r'''[rbuf]{0,2}"""(?P<t>[^"]+)"""|[rbuf]{0,2}"(?P<d>(?:[^"\\\n]|\\.)*)"|[rbuf]{0,2}'(?P<s>(?:[^'\\\n]|\\.)*)'|`(?P<k>[^`\n]*)`'''
ASSIGN = re.compile(
    rf"""(?P<key>[A-Za-z_$][\w$.-]*|(?<=/:)_\w+)["'`]?\]?\s*(?::\s*[A-Za-z_][\w.<>\[\]| ]*(?=\s*=[^=]))?\s*(?:=>|:=|\?\?=|\|\|=|=(?!=)|:(?!//|:))[ \t]*(?:[(][ \t]*)?(?:{_QUOTED}|(?P<b>[^\s"'`][^\n]*))"""
)
CALL = re.compile(r"""["'](?P<key>[A-Za-z_][\w.-]*)["']\s*,\s*(?:"(?P<d>[^"\n]*)"|'(?P<s>[^'\n]*)'|`(?P<k>[^`\n]*)`)""")
FALLBACK = re.compile(r"""(?:\|\||\?\?|\bor\b|,|:-|:=|\belse\b)\s*(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`)""")
XML = re.compile(r"""<([A-Za-z_][\w.:-]*)(?:\s[^<>]*)?>([^<>\n]+)</\1>""")
NAMED = re.compile(r"""(?i)^\s*-?\s*["']?(?:name|key)["']?\s*[:=]\s*["']?([A-Za-z_][\w.-]*)["']?\s*,?\s*\r?$""")
VALUE = re.compile(r"""(?i)^\s*-?\s*["']?value["']?\s*[:=]\s*(?:"([^"\n]*)"|'([^'\n]*)'|([^\s"'#][^\n#]*?))\s*,?\s*\r?$""")
INLINE = re.compile(r"""(?i)["']?\b(?:name|key)["']?\s*[:=]\s*["']?([A-Za-z_][\w.-]*)["']?\s*,\s*["']?value["']?\s*[:=]\s*(?:"([^"\n]*)"|'([^'\n]*)'|([^\s"',}]+))""")
BLOCK = re.compile(r"""^(?P<in>\s*)(?:-\s+)?["']?(?P<key>[A-Za-z_][\w.-]*)["']?\s*(?::\s*[|>][-+]?\d?|[:=]\s*\\?)[ \t]*\r?$""")
PLUS = re.compile(r"""\s*(?:\+|\.)?\s*(?:\\?\r?\n\s*)?["']([^"'\n]*)["']""")
COMMENT = re.compile(r"""\s*(?:#|//|\*|--|;|<!--|/\*|\"\"\"|rem\b)""", re.I)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
#: Formats whose values need no quotes.
BARE = frozenset("env ini toml yaml yml properties cfg conf npmrc netrc pypirc sh bash zsh shell console dockerfile docker tf hcl xml text txt csv dotenv makefile".split())
CODE = frozenset("py python js javascript ts typescript jsx tsx go java kt rb ruby rs rust c cpp cs php swift scala json jsonc json5 lua r pl".split())


def sensitive(key: str) -> bool:
    """Whether a key names a credential: its last word decides, so settings about one (length, file, policy) do not count."""
    words = [w.lower() for w in WORDS.findall(key)]
    while words and (words[-1] in TAIL or words[-1].isdigit()) and len(words) > 1:
        words.pop()
    if not words:
        return False
    last = words[-1]
    if last in NAMES or "".join(words[-2:]) in NAMES:
        return True
    return last in ("key", "keys") and len(words) > 1 and words[-2] in KEYS and words[-2] != "public"


#: Words whose plural holds credentials by name, and keys of such a collection that tell about one.
_PLURAL = frozenset("passwords passphrases passcodes secrets tokens credentials keys apikeys creds".split())
_ABOUT = frozenset(
    "id ids name names user username login email host hostname url uri endpoint path file dir region zone type kind provider algorithm alg hash digest sha sha1 sha256 checksum fingerprint public version length"
    " count size min max ttl expiry expires created updated date issuer audience scope scopes role description comment label format policy ref from commit revision image tag arn account owner prefix pattern regex".split()
)
_NAMING = frozenset("name key variable var".split())
#: How things are called rather than what they are.
_SLUG = re.compile(r"[A-Za-z]+(?:[-_./][A-Za-z]+)*[-_./]?v?\d{0,3}")
#: Every name of a credential has one of these.
_HINT = re.compile(r"pass|pw|secret|token|cred|auth|key|bearer")


def _inherits(key: str | int) -> bool:
    """Whether a key says nothing by itself: a place in a list, or words such as default, value and prod."""
    if not isinstance(key, str):
        return True
    words = WORDS.findall(key)
    return bool(words) and all(w.lower() in TAIL or w.isdigit() for w in words)


def _collection(key: str) -> bool:
    words = [w.lower() for w in WORDS.findall(key)]
    return bool(words) and words[-1] in _PLURAL and (words[-1] != "keys" or len(words) > 1 and words[-2] in KEYS)


def path_named(path: tuple[str | int, ...]) -> str:
    """Whether a key path names a credential: 'named', or 'held' for items and any keys of a collection of credentials, or ''."""
    rest = list(path)
    while rest and _inherits(rest[-1]):
        rest.pop()
    if not rest:
        return ""
    if sensitive(rest[-1]) or _collection(rest[-1]):
        return "held" if isinstance(path[-1], int) else "named"
    if (WORDS.findall(rest[-1]) or [""])[-1].lower() in _ABOUT:
        return ""
    rest.pop()
    while rest and _inherits(rest[-1]):
        rest.pop()
    return "held" if rest and _collection(rest[-1]) else ""


def _entries(text: str, lo: int, hi: int, fmt: str) -> Iterator[tuple[int, int, str, str]]:
    """Findings of a part in a configuration format, by the whole key path of every value."""
    if not (reader := keypaths.READERS.get(fmt)):
        return
    for some in keypaths.entries(text, lo, hi, reader):
        some = [e for e in some if e.path]
        names = {e.within: text[e.start : e.end] for e in some if isinstance(e.path[-1], str) and e.path[-1].lower() in _NAMING}
        kinds = {e.path[:-1] for e in some if e.path[-1] == "kind" and text[e.start : e.end] == "Secret"} if reader == "braces" else ()
        for e in some:
            path, v = e.path, text[e.start : e.end]
            if e.within in names and isinstance(path[-1], str) and _inherits(path[-1]):  # {name: ..., value: ...}
                path = (*path[:-1], names[e.within], path[-1])
            how = path_named(path)
            if kinds and any(path[: len(k)] == k and path[len(k) : len(k) + 1] in (("data",), ("stringData",)) for k in kinds):
                inner = _decoded(v) if path[-2] == "data" else v
                if literal(v) and (inner or shaped(v)) and literal(inner or "ok1!ok"):
                    yield e.start, e.end, "entry", ".".join(map(str, path))
                continue
            v = re.sub(r"\s+", "", v) if "\n" in v else v
            if how and shaped(v, strict=how == "held") and not HEADER.fullmatch(v) and not (how == "held" and _SLUG.fullmatch(v)):
                yield e.start, e.end, "entry", ".".join(map(str, path))


def mixed(value: str) -> int:
    """How many kinds of characters a value has: lower, upper, digits, others."""
    return sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))


def literal(value: str) -> bool:
    """Whether a value is neither a reference nor a dummy."""
    return bool(value) and not REFERENCE.search(value) and not DUMMY.search(value)


def shaped(value: str, strict: bool = False) -> bool:
    """Whether a literal looks like a credential rather than a word, number, path, call or setting."""
    v = value.strip()
    if len(v) < (8 if strict else 6) or " " in v or not literal(v):
        return False
    if KNOWN.search(v) or UUID.fullmatch(v):
        return True
    if re.fullmatch(r"[\d.,:_-]+|[A-Za-z]+|[a-z]+(?:[-_. ][a-z]+)*|[A-Z]+(?:_[A-Z]+)*|[A-Za-z_][\w.]*\(.*|[\w.]+\[.*|min-?\d+|v?\d+(?:\.\d+)+\S*|\d+(?:ms|s|m|h|d|kb|mb|gb)", v):
        return bool(re.fullmatch(r"[A-Za-z]{16,}", v)) and bool(re.search(r"[a-z][A-Z]\w*[a-z][A-Z]", v)) and not strict
    if strict:
        return bool(re.search(r"\d", v)) and (mixed(v) >= 3 or bool(re.fullmatch(r"[0-9a-f]{24,}", v)) or len(v) >= 20)
    return mixed(v) >= 2


def _decoded(value: str) -> str | None:
    """The printable text that base64 letters stand for, if any."""
    v = value.rstrip("=")
    if len(v) < 8 or not re.fullmatch(r"[A-Za-z0-9+/_-]+", v):
        return None
    try:
        raw = base64.b64decode(v.replace("-", "+").replace("_", "/") + "=" * (-len(v) % 4))
        text = raw.decode("utf-8")
    except (binascii.Error, UnicodeDecodeError, ValueError):
        return None
    return text if text.strip() and all(c.isprintable() or c in "\r\n\t" for c in text) else None


def _bare(value: str, fmt: str, before: str = "") -> str:
    """A value without quotes: up to a comment, to the end of a quoted text that holds it (a connection string; before is what
    the line has before the value) and of its part of that, and to the first blank where the format says so."""
    v = re.split(r"\s+[#;]|\s+//", value, maxsplit=1)[0].rstrip().rstrip("\r")
    for q in "\"'":
        if before.count(q) % 2:
            v = v.split(q, 1)[0]
    v = re.split(r";(?=\s*(?:[A-Za-z][\w ]*=|$))", v, maxsplit=1)[0]
    if fmt in ("yaml", "yml"):
        v = v.rstrip(",")
    elif fmt in ("sh", "bash", "zsh", "shell", "console", "dockerfile", "docker", ""):
        v = re.split(r"[\s;|&)]", v, maxsplit=1)[0]
    return v


def _group(m: re.Match, *names) -> tuple[str, int] | None:
    for n in names:
        if m.group(n) is not None:
            return m.group(n), m.start(n)
    return None


def _line(line: str, fmt: str, prose: bool) -> Iterator[tuple[int, int, str, str]]:
    """Findings of one line: (start, end, kind, key)."""
    for rx in (KNOWN, PREFIXED):
        for m in rx.finditer(line):
            if literal(m[0]):
                yield m.start(), m.end(), "token", ""
    for m in URL.finditer(line):
        if len(m[2]) >= 4 and literal(m[2]) and not re.fullmatch(r"[A-Z_]+|\d+", m[2]):
            yield m.start(2), m.end(2), "login", m[1]
    for m in HEADER.finditer(line):
        v = m[2]
        text = _decoded(v) if m[1].lower() == "basic" else None
        if m[1].lower() == "basic":
            ok = text is not None and ":" in text and literal(text.partition(":")[2])
        elif m[1].lower() == "bearer" or AUTHORIZATION.search(line[: m.start()]):
            ok = shaped(v)
        else:
            ok = False
        if ok:
            yield m.start(2), m.end(2), "header", m[1]
    for rx, kind in ((OPTION, "option"), (USER, "login")):
        for m in rx.finditer(line):
            v, s = _group(m, 1, 2, 3)
            if literal(v) and len(v) >= 6 and (shaped(v) or m[1] or m[2]) and not re.fullmatch(r"[a-z]+|[A-Z_]+|\d+", v):
                yield s, s + len(v), kind, ""
    for m in DECODED.finditer(line):
        v, s = _group(m, 1, 2)
        text = _decoded(v)
        if text and (KNOWN.search(text) or shaped(text.strip()) or URL.search(text) or "PRIVATE KEY" in text):
            yield s, s + len(v), "encoded", ""
    for m in XML.finditer(line):
        if sensitive(m[1]) and shaped(m[2]):
            yield m.start(2), m.end(2), "entry", m[1]
    for m in INLINE.finditer(line):
        v, s = _group(m, 2, 3, 4)
        if sensitive(m[1]) and shaped(v):
            yield s, s + len(v), "entry", m[1]
    pos = 0
    while m := ASSIGN.search(line, pos):
        pos = m.start("key") + len(m["key"])
        key = m["key"]
        if not sensitive(key):
            continue
        got = _group(m, "t", "d", "s", "k")
        if got:
            v, s = got
            end = s + len(v)
            whole = v
            while p := PLUS.match(line, end + 1):  # parts of one literal
                if not re.search(r"[+.]|\n|^\s*[\"']", line[end + 1 : p.start(1)]):
                    break
                whole, end = whole + p[1], p.end(1)
            inner = HEADER.fullmatch(whole.strip())
            if inner:
                continue
            if shaped(whole):
                yield s, end, "entry", key
            pos = max(pos, end)
        else:
            rest, s = m["b"], m.start("b")
            for f in FALLBACK.finditer(rest):
                v, at = _group(f, 1, 2, 3)
                if shaped(v):
                    yield s + at, s + at + len(v), "entry", key
            d = re.match(r"""["']?\$\{\w+:[-=]([^}"']+)\}""", rest)
            if d and shaped(d[1]):
                yield s + d.start(1), s + d.end(1), "entry", key
            if fmt not in CODE or COMMENT.match(line):
                v = _bare(rest, "sh" if fmt in CODE else fmt, line[:s])
                if shaped(v) and not re.match(r"[A-Za-z_][\w.]*[(\[]", v) and not v.startswith(("{", "[", "(")):
                    yield s, s + len(v), "entry", key
    for m in CALL.finditer(line):
        v, s = _group(m, "d", "s", "k")
        if sensitive(m["key"]) and shaped(v):
            yield s, s + len(v), "entry", m["key"]
    for m in NETRC.finditer(line):
        if fmt in ("netrc",) or re.search(r"\b(?:machine|login)\b", line) or re.fullmatch(r"\s*#?\s*password\s+\S+\s*", line):
            v = m[2].rstrip(",.;`'")
            if shaped(v):
                yield m.start(2), m.start(2) + len(v), "entry", "password"
    if prose or COMMENT.match(line):
        for m in PROSE.finditer(line):
            v, s = _group(m, 2, 3, 4, 5)
            quoted = m[5] is None
            if not quoted:
                v = v.rstrip(".!?)]}`'\"\r")
            named = m[1].lower().startswith("pass") or m[1].lower() == "pwd"
            ok = shaped(v, strict=not (named or quoted)) and bool(re.search(r"\d", v))
            if ok and named and not quoted:
                ok = mixed(v) >= 2 and bool(re.search(r"[A-Za-z]", v)) and not re.match(r"--?\w|\w+=", v)
            if ok and quoted and not named:
                ok = shaped(v, strict=True) and not re.search(r"[=<>/ ]", v.rstrip("="))
            if ok:
                yield s, s + len(v), "prose", m[1]


def _table(text: str, lo: int, hi: int) -> list[tuple[int, int, str, str]]:
    """Findings of a Markdown table whose head is the line lo:hi: values in the columns that are named like credentials."""
    after = text.find("\n", hi + 1)
    if not re.fullmatch(r"\s*\|?[\s:|-]+\|?\s*", text[hi + 1 : after if after >= 0 else len(text)] or "x"):
        return []
    heads = [h.strip(" `*\r") for h in text[lo:hi].strip().strip("|").split("|")]
    wanted = [i for i, h in enumerate(heads) if sensitive(h.replace(" ", "_"))]
    out = []
    while wanted and after >= 0:
        at = after + 1
        after = text.find("\n", at)
        row = text[at : after if after >= 0 else len(text)]
        if not row.lstrip().startswith("|"):
            break
        cells = list(re.finditer(r"[^|\r\n]+", row))
        for i in wanted:
            if i < len(cells):
                v = cells[i][0].strip(" `*\"'")
                if shaped(v):
                    s = at + cells[i].start() + cells[i][0].index(v)
                    out.append((s, s + len(v), "table", heads[i]))
    return out


def _formats(text: str, path: str | None) -> list[tuple[int, int, str, bool]]:
    """(start, end, format, prose) of the parts of a text: the file's format, or in Markdown the fenced blocks and the rest."""
    name = (path or "").rsplit("/", 1)[-1].lower()
    ext = name.rsplit(".", 1)[-1] if "." in name else name
    if path and ext not in ("md", "mdc", "markdown", "mdx", "rst", "txt"):
        return [(0, len(text), ext, False)]
    out, at, fence, lang = [], 0, "", ""
    pos = 0
    for m in re.finditer(r"(?m)^[ \t]*(`{3,}|~{3,})[ \t]*([\w+-]*)[^\n]*\n?", text):
        if not fence:
            out.append((at, m.start(), "", True))
            fence, lang, at = m[1], m[2].lower(), m.end()
        elif m[1][0] == fence[0] and len(m[1]) >= len(fence) and not m[2]:
            out.append((at, m.start(), lang or "text", False))
            fence, at = "", m.end()
        pos = m.end()
    out.append((at, len(text), (lang or "text") if fence else "", not fence))
    return [p for p in out if p[0] < p[1]]


def _config(text: str, parts: list[tuple[int, int, str, bool]]) -> Iterator[tuple[int, int, str, bool]]:
    """The parts that may be configuration: with a leading frontmatter block, and blocks without a language by their look."""
    if parts and parts[0][3] and (m := re.match(r"---[ \t]*\r?\n([\s\S]*?)\n---[ \t]*\r?(?:\n|$)", text)):
        yield m.start(1), m.end(1), "yaml", False
    for lo, hi, fmt, prose in parts:
        if fmt in ("text", "txt", "") and not prose:
            body = text[lo:hi]
            fmt = "json" if re.match(r"\s*[{\[]\s*[\"{]", body) else "ini" if re.search(r"(?m)^\[[\w. -]+\]\s*$", body) else "yaml" if re.search(r"(?m)^\s*(?:- )?[\w.-]+:\s*$", body) else fmt
        if not prose:
            yield lo, hi, fmt, prose


def find_secrets(text: str | None, path: str | None = None) -> list[Finding]:
    """The credentials of a text, in order, without overlaps."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    keys = [(m.start(), m.end()) for m in PEM.finditer(text)] if "PRIVATE KEY" in text else []
    found += [(s, e, "private_key", "") for s, e in keys if re.search(r"[A-Za-z0-9+/]{16}", text[s:e].split("-----")[2] if text[s:e].count("-----") > 2 else text[s : s + 400])]
    parts = _formats(text, path)
    starts = [p[0] for p in parts]
    low = text.lower()
    if len(low) == len(text):
        hits = [end for end, _ in _finder.iter(low)]
    else:  # a few letters grow when lowered, so places would shift
        hits = [m.end() - 1 for m in _SLOW.finditer(text)]
    tails = [m.start() for m in _TAILED.finditer(text)]
    if tails:
        hits = sorted(hits + tails)
    done = -1
    for at in hits:
        if at <= done:
            continue
        lo = text.rfind("\n", 0, at) + 1
        hi = text.find("\n", at)
        hi = len(text) if hi < 0 else hi
        done = hi
        line = text[lo:hi]
        if line.lstrip().startswith("|") and (rows := _table(text, lo, hi)):
            found += rows
        if not _WORTH.search(line):
            continue
        _, _, fmt, prose = parts[max(0, bisect_right(starts, at) - 1)]
        found += [(lo + s, lo + e, k, key) for s, e, k, key in _line(line, fmt, prose)]
        after = text.find("\n", hi + 1)
        nxt = text[hi + 1 : len(text) if after < 0 else after]
        if (m := NAMED.match(line)) and sensitive(m[1]) and (v := VALUE.match(nxt)):
            got = _group(v, 1, 2, 3)
            if shaped(got[0]):
                found.append((hi + 1 + got[1], hi + 1 + got[1] + len(got[0]), "entry", m[1]))
        if (m := BLOCK.match(line)) and sensitive(m["key"]) and (v := re.match(r"""\s*["']?([^\s"']+)["']?,?\s*\r?$""", nxt)):
            if len(nxt) - len(nxt.lstrip()) > len(m["in"]) and shaped(v[1]) and ":" not in v[1][:-1] and not nxt.lstrip().startswith("- "):
                found.append((hi + 1 + v.start(1), hi + 1 + v.end(1), "entry", m["key"]))
        if m := re.search(r"""(?:=|:|\()\s*\(?\s*\\?\r?$""", line):
            k = re.search(r"""([A-Za-z_][\w.-]*)["']?\s*(?::\s*\w+\s*)?[=:]\s*\(?\s*\\?\r?$""", line)
            v = re.match(r"""\s*["']([^"'\n]+)["']""", nxt)
            if k and v and sensitive(k[1]) and shaped(v[1]):
                found.append((hi + 1 + v.start(1), hi + 1 + v.end(1), "entry", k[1]))
    if "kind: Secret" in text:  # every value under data or stringData of such a manifest
        for m in re.finditer(r"(?m)^kind: Secret[ \t]*\r?\n((?:[^\n]*\n)*?)(?=---|kind:|```|\Z)", text + "\n"):
            inside = False
            at = m.start(1)
            for raw in m[1].splitlines(keepends=True):
                if re.match(r"(?:data|stringData):\s*$", raw):
                    inside = True
                elif inside and (v := re.match(r"""\s+["']?[\w.-]+["']?:\s*["']?([^\s"']+)""", raw)):
                    if literal(v[1]) and (_decoded(v[1]) or shaped(v[1])) and literal(_decoded(v[1]) or "ok1!ok"):
                        found.append((at + v.start(1), at + v.end(1), "entry", "data"))
                elif raw.strip() and not raw[0].isspace():
                    inside = False
                at += len(raw)
    if _HINT.search(low):
        found.sort()
        more, apart = [], []  # apart: begin, end and findings of what overlaps
        for f in found:
            if apart and f[0] < apart[-1][1]:
                apart[-1][1] = max(f[1], apart[-1][1])
                apart[-1][2].append(f)
            else:
                apart.append([f[0], f[1], [f]])
        for lo, hi, fmt, _ in _config(text, parts):
            for f in _entries(text, lo, hi, fmt):
                k = bisect_right(apart, f[0], key=lambda a: a[0])
                met = [a for a in apart[max(0, k - 1) : k + 1] if a[0] < f[1] and f[0] < a[1]]
                if not met:
                    more.append(f)
                elif len(met) == 1 and all(o[2] == "entry" for o in met[0][2]) and "\n" not in text[f[0] : f[1]]:
                    # the reader knows where the value ends and what the whole key path is
                    met[0][2] = [f]
        found = [*(f for a in apart for f in a[2]), *more]
    found.sort(key=lambda f: (f[0], -f[1]))
    out: list[Finding] = []
    for s, e, k, key in found:
        if e > len(text) or any(a <= s < b for a, b in keys) and k != "private_key":
            continue
        if out and s < out[-1].end:
            if e > out[-1].end:
                out[-1] = Finding(out[-1].start, e, out[-1].kind, out[-1].key)
            continue
        out.append(Finding(s, e, k, key))
    return out


def redact(text: str | None, path: str | None = None, mask: str = "REDACTED") -> str | None:
    """The text with every credential's bytes replaced; everything else, line ends included, byte for byte the same. Line feeds
    inside a private key stay, so that line numbers do."""
    if not text:
        return text
    out, pos = [], 0
    for f in find_secrets(text, path):
        value = text[f.start : f.end]
        out += [text[pos : f.start], re.sub(r"[^\r\n]+", mask, value) if f.kind == "private_key" else mask]
        pos = f.end
    return "".join([*out, text[pos:]])


def scan(files: DataFrame) -> DataFrame:
    """files (source_table, record_id, file_path, content, is_file) -> one row per finding: (source_table, record_id, file_path,
    line_no, kind, key, byte_start, byte_end)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for src, rid, path, text, is_file in zip(*(batch[c].to_pylist() for c in ("source_table", "record_id", "file_path", "content", "is_file")), strict=True):
                line, byte, pos = 1, 0, 0
                for f in find_secrets(text, path if is_file else None):
                    gap = text[pos : f.start]
                    line += gap.count("\n")
                    byte += len(gap.encode("utf-8", "surrogatepass"))
                    value = text[f.start : f.end]
                    n = len(value.encode("utf-8", "surrogatepass"))
                    rows.append((src, rid, path, line, f.kind, f.key, byte, byte + n))
                    line, byte, pos = line + value.count("\n"), byte + n, f.end
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            names = ["source_table", "record_id", "file_path", "line_no", "kind", "key", "byte_start", "byte_end"]
            kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    schema = "source_table string, record_id string, file_path string, line_no bigint, kind string, key string, byte_start bigint, byte_end bigint"
    return files.select("source_table", "record_id", "file_path", "content", "is_file").mapInArrow(work, schema)


def redacted(files: DataFrame) -> DataFrame:
    """files as for scan() -> (source_table, record_id, file_path, content), credentials masked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, flags = batch["file_path"].to_pylist(), batch["is_file"].to_pylist()
            new = [redact(t, p if f else None) for t, p, f in zip(batch["content"].to_pylist(), paths, flags, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["source_table"], batch["record_id"], batch["file_path"], pa.array(new, pa.string())], ["source_table", "record_id", "file_path", "content"])

    schema = "source_table string, record_id string, file_path string, content string"
    return files.select("source_table", "record_id", "file_path", "content", "is_file").mapInArrow(work, schema)
