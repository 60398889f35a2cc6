"""Configuration formats read into scalar values with their key paths and offsets: YAML, JSON, TOML, INI, HCL and XML.

The readers are tolerant: what they cannot read they pass over, so that fragments, templates and comments between do no harm.
Offsets are those of the text given; a value is without its quotes.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

#: The reader of every format, by file extension or by the language of a fenced block.
READERS = dict.fromkeys("yaml yml".split(), "yaml") | dict.fromkeys("json jsonc json5 tfstate webmanifest hcl tf tfvars terraform nomad".split(), "braces")
READERS |= {"toml": "toml"} | dict.fromkeys("ini cfg conf cnf properties".split(), "ini")
READERS |= dict.fromkeys("xml config csproj vbproj props targets plist nuspec resx settings".split(), "xml")


class Entry(NamedTuple):
    path: tuple[str | int, ...]
    start: int
    end: int
    #: The mapping that holds it; entries of one mapping have the same.
    within: int


_TOKEN = re.compile(
    r"""(?P<c>(?<!\S)\#[^\n]*|(?<!:)//[^\n]*|/\*[\s\S]*?\*/)|<<[-~]?(?P<tag>\w+)\r?\n(?P<here>[\s\S]*?)\r?\n[ \t]*(?P=tag)\b"""
    r"""|(?P<q>\"{3}|'{3})(?P<long>[\s\S]*?)(?P=q)|"(?P<d>(?:\\.|[^"\\\n])*)"|'(?P<s>(?:\\.|[^'\\\n])*)'|(?P<n>\n)|(?P<p>[{}\[\]=:,()])|(?P<w>[^\s{}\[\]=:,()"']+|["'])"""
)
_SECTION = re.compile(r"[ \t]*\[\[?([^\]\n]+)\]\]?[ \t]*(?:[#;][^\n]*)?\r?$", re.M)
_PART = re.compile(r""""([^"]*)"|'([^']*)'|([^\s."':/]+)""")


def _parts(key: str) -> tuple[str, ...]:
    return tuple(m[1] or m[2] or m[3] or "" for m in _PART.finditer(key))


class _Frame:
    def __init__(self, path: tuple, listed: bool):
        self.path, self.listed, self.n = path, listed, 0


def braces(text: str, lo: int, hi: int, base: tuple = (), sections: bool = False, once: bool = False) -> Iterator[Entry | int]:
    """JSON, HCL and, with sections, TOML. With once, a single value from lo, whose end is given last."""
    stack, head, key, bare, call = [_Frame(base, once)], [], None, None, 0
    at = lo

    def ended() -> Iterator[Entry]:
        nonlocal bare, key, head
        top = stack[-1]
        if bare and not call:
            yield Entry((*top.path, *(key or ((top.n,) if top.listed else ()))), *bare, id(top))
        bare = key = None
        head = []

    keep = []  # frames stay, so that their ids are not used again
    while at < hi:
        if sections and len(stack) == 1 and (at == lo or text[at - 1] == "\n") and (m := _SECTION.match(text, at, hi)):
            stack, head, key, bare, at = [_Frame((*base, *_parts(m[1])), False)], [], None, None, m.end()
            keep.append(stack[0])
            continue
        m = _TOKEN.search(text, at, hi)
        if not m:
            break
        at, top, kind = m.end(), stack[-1], m.lastgroup
        if kind == "n":
            if bare and not call or key is None:
                yield from ended()
        elif kind == "p":
            p = m[0]
            if p in "{[":
                inner = key if key is not None else (top.n,) if top.listed else tuple(head)
                stack.append(_Frame((*top.path, *inner), p == "["))
                keep.append(stack[-1])
                head, key, bare = [], None, None
            elif p in "}]":
                yield from ended()
                if len(stack) > 1:
                    stack.pop()
                head, key, bare = [], None, None
                if once and len(stack) == 1:
                    break
            elif p == ",":
                if not call:
                    yield from ended()
                    top.n += 1
            elif p in "=:":
                if bare:
                    bare = (bare[0], m.end())
                elif key is None and head:
                    key, head = _parts(head[-1]) if sections else (head[-1],), []
            elif p == "(":
                call, bare = call + 1, None
            else:
                call = max(0, call - 1)
                if not call:
                    key = None
        elif kind == "w":
            if key is not None or top.listed:
                bare = (bare[0] if bare else m.start(), m.end())
            else:
                head.append(m[0])
        elif kind != "c":
            name = next(g for g in ("here", "long", "d", "s") if m[g] is not None)
            if key is not None or top.listed and not re.match(r"\s*:", text[at : at + 20]):
                if not call and not bare:
                    bare = m.span(name)
                    yield from ended()
            else:
                head.append(m[name])
    else:
        at = hi
    yield from ended()
    if once and len(stack) == 1:  # a value that is not closed has no end
        yield at


_YAML_KEY = re.compile(r"""("[^"\n]*"|'[^'\n]*'|[^\s#"'{}\[\],&*!|>%@`-][^\n]*?|-[^\s][^\n]*?)[ \t]*:(?:[ \t]+|(?=\r?$))""")
_YAML_TAG = re.compile(r"(?:[&!][^\s]*[ \t]+)+")
_YAML_QUOTED = re.compile(r""""((?:\\.|[^"\\])*)"|'((?:''|[^'])*)'""")


def _block(text: str, end: int, hi: int, indent: int) -> int:
    """Where the lines end that belong to a value whose first line ends at end: they stand further in, or close a bracket."""
    while end < hi:
        e = text.find("\n", end + 1, hi)
        e = hi if e < 0 else e
        line = text[end + 1 : e]
        body = line.lstrip()
        if body and len(line) - len(body) <= indent and body[0] not in "}]":
            break
        end = e
    return end


def yaml(text: str, lo: int, hi: int) -> Iterator[Entry]:
    root = _Frame((), False)
    stack: list[tuple[int, _Frame]] = [(-1, root)]
    keep = [root]  # frames stay, so that their ids are not used again
    at = lo

    def push(indent: int, key: str | int, listed: bool) -> None:
        stack.append((indent, _Frame((*stack[-1][1].path, key), listed)))
        keep.append(stack[-1][1])

    while at < hi:
        end = text.find("\n", at, hi)
        end = hi if end < 0 else end
        pos, nxt = at, end + 1
        while pos < end and text[pos] in " \t":
            pos += 1
        line = text[pos:end].rstrip()
        if line in ("---", "..."):
            stack = [(-1, root := _Frame((), False))]
            keep.append(root)
        if not line or line[0] == "#" or line in ("---", "..."):
            at = nxt
            continue
        while line == "-" or line.startswith(("- ", "-\t")):
            indent = pos - at
            while stack[-1][0] > indent or stack[-1][0] == indent and stack[-1][1].listed:
                stack.pop()
            parent = stack[-1][1]
            push(indent, parent.n, True)
            parent.n += 1
            pos += 1
            while pos < end and text[pos] in " \t":
                pos += 1
            line = text[pos:end].rstrip()
        indent = pos - at
        m = _YAML_KEY.match(text, pos, end)
        while stack[-1][0] >= indent:
            stack.pop()
        top = stack[-1][1]
        path = top.path
        if m:
            key = m[1][1:-1] if m[1][0] in "\"'" else m[1]
            path = (*path, key)
            pos = m.end()
        if tag := _YAML_TAG.match(text, pos, end):
            pos = tag.end()
        rest = text[pos:end].rstrip()
        if not rest or rest[0] == "#" or rest[0] in "&!" and " " not in rest:
            if m:
                push(indent, key, False)
        elif rest[0] in "|>" and re.fullmatch(r"[|>][-+\d]*(?:\s+#.*)?", rest):
            start = stop = None
            least = stack[-1][0] if not m else indent
            while nxt < hi:
                e = text.find("\n", nxt, hi)
                e = hi if e < 0 else e
                body = text[nxt:e]
                if body.strip() and len(body) - len(body.lstrip()) <= least:
                    break
                if body.strip():
                    start = nxt + len(body) - len(body.lstrip()) if start is None else start
                    stop = nxt + len(body.rstrip())
                nxt = e + 1
            if start is not None:
                yield Entry(path, start, stop, id(top))
        elif rest[0] in "{[":
            for got in braces(text, pos, _block(text, end, hi, indent if m else stack[-1][0]), path, once=True):
                if isinstance(got, int):
                    nl = text.find("\n", got, hi)
                    nxt = max(nxt, hi if nl < 0 else nl + 1)
                else:
                    # the frame of once counts as a list of one
                    yield got._replace(path=(*path, *got.path[len(path) + 1 :]))
        elif rest[0] in "\"'" and (q := _YAML_QUOTED.match(text, pos, end) or _YAML_QUOTED.match(text, pos, _block(text, end, hi, indent if m else stack[-1][0]))):
            yield Entry(path, *q.span(1 if q[1] is not None else 2), id(top))
            nxt = max(nxt, (text.find("\n", q.end(), hi) + 1 or hi))
        else:
            value = re.split(r"\s#", rest, maxsplit=1)[0].rstrip(" \t,")
            yield Entry(path, pos, pos + len(value), id(top))
        at = nxt


_INI = re.compile(r"[ \t]*(?:export[ \t]+)?([^\s=:#;\[][^=:\n]*?)[ \t]*[=:][ \t]*([^\n]*)")


def ini(text: str, lo: int, hi: int) -> Iterator[Entry]:
    section, n, at = (), 0, lo
    while at < hi:
        end = text.find("\n", at, hi)
        end = hi if end < 0 else end
        if m := _SECTION.match(text, at, end):
            section, n = _parts(m[1]), n + 1
        elif m := _INI.match(text, at, end):
            value, s = re.split(r"\s[#;]", m[2], maxsplit=1)[0].rstrip(), m.start(2)
            if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                value, s = value[1:-1], s + 1
            yield Entry((*section, *_parts(m[1])), s, s + len(value), n)
        at = end + 1


_MARKUP = re.compile(r"""<!--[\s\S]*?-->|<\?[\s\S]*?\?>|<!\[CDATA\[(?P<data>[\s\S]*?)\]\]>|<(?P<end>/)?(?P<name>[A-Za-z_][\w.:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^<>"'])*)>|(?P<text>[^<]+)""")
_ATTRIBUTE = re.compile(r"""([A-Za-z_][\w.:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)')""")


def xml(text: str, lo: int, hi: int) -> Iterator[Entry]:
    """Attributes and texts of elements; a text after an element <key> has that element's text for its key, as in property lists."""
    stack: list[list] = [["", None, 0]]  # element, text of the last <key> in it, number
    n = 0
    for m in _MARKUP.finditer(text, lo, hi):
        group = "text" if m["text"] is not None else "data"
        if m[group] is not None:
            value, (name, _, _) = m[group].strip(), stack[-1]
            if not value or len(stack) == 1:
                continue
            parent = stack[-2]
            if name == "key":
                parent[1] = value
            s = m.start(group) + m[group].index(value)
            above = [x for name, key, _ in stack[1:-1] for x in ((name, key) if key else (name,))]
            yield Entry((*above, name) if not parent[1] or name == "key" else tuple(above), s, s + len(value), -parent[2])
        elif m["name"] and m["end"]:
            while len(stack) > 1:  # elements that were not closed end with those around them
                name = stack.pop()[0]
                if name == m["name"]:
                    if name != "key":
                        stack[-1][1] = None
                    break
        elif m["name"]:
            n += 1
            for a in _ATTRIBUTE.finditer(text, m.start("rest"), m.end("rest")):
                g = 2 if a[2] is not None else 3
                yield Entry((*(name for name, _, _ in stack[1:]), m["name"], a[1]), a.start(g), a.end(g), n)
            if not m["rest"].rstrip().endswith("/"):
                stack.append([m["name"], None, n])


_COMMENTED = re.compile(r"(?m)(?:^[ \t]*(?:#|//|;)[^\n]*(?:\n|\Z))+")


def entries(text: str, lo: int, hi: int, reader: str) -> list[list[Entry]]:
    """The entries of text[lo:hi], and those of lines that are commented out there: in their place, and every run by itself."""
    read = {"yaml": yaml, "ini": ini, "braces": braces, "xml": xml, "toml": lambda t, a, b: braces(t, a, b, sections=True)}[reader]
    out = [list(read(text, lo, hi))]
    runs = list(_COMMENTED.finditer(text, lo, hi))
    if runs:
        marks = lambda t: re.sub(r"(?m)^([ \t]*)(#+|//+|;+)", lambda c: c[1] + " " * len(c[2]), t)
        bare = marks(text[lo:hi])
        places = [range(m.start() - lo, m.end() - lo) for m in runs]
        out.append([e._replace(start=e.start + lo, end=e.end + lo) for e in read(bare, 0, len(bare)) if (k := bisect_right(places, e.start, key=lambda r: r.start)) and e.start in places[k - 1]])
        for r in places:
            out.append([e._replace(start=e.start + lo + r.start, end=e.end + lo + r.start) for e in read(bare[r.start : r.stop], 0, len(r))])
    return out
