"""Secret scans: fixed patterns, and literals that are assigned to sensitive names.

The base patterns find assignments to a few names, access keys and hexadecimal strings.  Beyond
them the whole text is read as source or configuration: a name before ``=``, ``:``, ``=>`` or ``:=`` opens a
pair, and its value is read token by token, over line ends where the syntax goes on there.  Values are
strings (also of triple quotes), bare words, concatenations, formatted strings, literals in brackets,
arguments of calls, block scalars below their key; elements ``<name>value</name>`` are pairs as well.  A
name that stands for an earlier constant passes its literals on (the last value before counts, the text's
blocks are not told apart).  A literal is scored by how sensitive the name is that receives it and by
how random the whole value looks.  Scans run in the tasks that read the documents, without a shuffle.

Spans are in code points, their end exclusive.  Defined cases: a null text is an empty one; repeated
rows are scanned each; an empty table gives no rows; other columns are ignored by ``scan`` and kept
by ``redact``.
"""

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.llm.common import aside, map_texts

KINDS = ("assign", "access", "hex", "literal")

# The base patterns and the lengths that a match needs.
ASSIGN = re.compile(
    r"""(?a)(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

#: How sensitive the parts of a name are.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "auth": 1.5, "bearer": 2.5,
    "private": 1.5, "access": 1.0, "api": 1.0, "key": 1.5, "pass": 2.0, "signing": 1.5, "salt": 1.5,
    "encryption": 1.5, "client": 0.5, "session": 1.0, "connection": 1.0, "dsn": 1.5,
}
#: Parts of a name that say that the value is not the secret itself.
HARMLESS = {"name", "id", "url", "path", "file", "type", "length", "count", "size", "limit", "public"}
PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|changeme|example.*|your.*|dummy.*|placeholder.*|none|null|true|false)$")
#: Least score (sensitivity of the name plus randomness of the literal) of a finding.
THRESHOLD = 4.5
MIN_LITERAL = 8

_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
_STRING = r'"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^\'\\]|\\.|\'(?!\'\'))*\'\'\'|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\''
#: What opens a pair: a name (perhaps quoted) and an assignment, or an element.  A name is only looked for
#: where its run of characters begins, so that long runs take linear time.
_HEAD = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])[0-9.\-]*+(?P<name>{_NAME}+)["']?[ \t]*(?:=>|:=|[:=](?![:=]))|<(?P<element>{_NAME})(?:\s[^<>]*)?>(?P<content>[^<>]+)</(?P=element)>""")
#: A token of a value; ``bare`` may be a number or a path as well as a name.
_TOKEN = re.compile(
    rf"""(?P<string>{_STRING})|(?P<bare>[A-Za-z0-9_][^\s,;"'`<>(){{}}\[\]]*)|(?P<open>[(\[])|(?P<close>[)\]])|(?P<join>[+%,])""", re.S)
_BLANK, _BLANKS, _BEHIND = re.compile(r"[ \t]*"), re.compile(r"(?:\s|\\\n)*"), re.compile(r"(?:[ \t]|\\\n)*")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?[0-9]?[ \t]*\n")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def base_spans(text) -> list:
    """(kind, start, end) of the base patterns: leftmost matches, those too short left out."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LENGTH]
    # A run of hexadecimal digits matches as a whole, so its length can be part of the pattern.
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return found


_LONG_HEX = re.compile(rf"{HEX.pattern[:-1]}{{{HEX_LENGTH},}}")


def sensitivity(name: str) -> float:
    """How likely a name is to hold a secret, from its parts."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts:
        return 0.0
    score = sum({p: SENSITIVE.get(p, 0.0) for p in parts}.values())
    return score - 2.0 * (parts[-1] in HARMLESS)


class Value:
    """Literals that a name stands for: their spans, the values they come from, and how they look."""

    __slots__ = ("spans", "parts", "counts", "size", "head", "told")

    def __init__(self, spans, parts, text):
        self.spans, self.parts, self.told = spans, parts, False
        chars = Counter(text)
        size, head = float(len(text)), text[:64]
        for part in parts:
            for c, k in part.counts.items():
                chars[c] += k
            size += part.size
            head = (head + part.head)[:64]
        if size > 1e9:  # shares are all that counts; they stay finite however often values are doubled
            chars, size = {c: k * 1e6 / size for c, k in chars.items()}, 1e6
        self.counts, self.size, self.head = chars, size, head

    def all_spans(self, found: set):
        """Add the spans of all literals; values that were told before are not walked again."""
        todo = [self]
        while todo:
            value = todo.pop()
            if not value.told:
                value.told = True
                found.update(("literal", start, end) for start, end in value.spans if end > start)
                todo += value.parts


def randomness(value) -> float:
    """Bits per character of a value, with a bonus for mixed character classes."""
    if isinstance(value, str):
        value = Value([], [], value)
    counts, head = value.counts, value.head
    if value.size < MIN_LITERAL or " " in counts or PLACEHOLDER.match(head) or head.startswith(("${", "{{")):
        return -10.0
    entropy = -sum(k / value.size * math.log2(k / value.size) for k in counts.values() if k)
    kinds = [any(a <= c <= z for c in counts) for a, z in (("a", "z"), ("A", "Z"), ("0", "9"))]
    other = any(not (c.isascii() and c.isalnum()) for c in counts)
    return entropy / 2 + 0.5 * (sum(kinds) + other - 2) - (0.0 if kinds[2] else 1.0)


def _block(text: str, head) -> tuple:
    """The lines of a block scalar (spans of what they say) and its end."""
    line = text.rfind("\n", 0, head.start()) + 1
    depth = len(_BLANK.match(text, line)[0])
    at, spans = _BLOCK.match(text, head.end()).end(), []
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        start = _BLANK.match(text, at).end()
        if start < end and start - at <= depth:
            break
        stop = start + len(text[start:end].rstrip())
        if stop > start:
            spans.append((start, stop))
        at = end + 1
    return spans, min(at, len(text))


def _value(text: str, at: int, constants: dict) -> tuple:
    """The value that begins at a place, or None, and its end.

    Inside brackets, and in front of a string, white space may hold line ends.  Terms follow each
    other if ``+``, ``%`` or, in brackets, a comma joins them, or if they are strings side by side.
    """
    spans, parts, words = [], [], []
    depth, joined, end, last = 0, True, at, None
    following = _BLANKS.match(text, at).end()
    if text[following:following + 1] in ("\"", "'"):
        at = following
    while True:
        at = (_BLANKS if depth else _BEHIND).match(text, at).end()
        m = _TOKEN.match(text, at)
        if not m or (m.lastgroup in ("string", "bare") and not joined and not (
                m.lastgroup == "string" and last == "string")):
            break
        kind, token = m.lastgroup, m[0]
        if kind == "open":
            if last == "string":
                break
            if last == "bare" and text[at - 1:at].isspace():
                break
            depth, joined = depth + 1, True
        elif kind == "close":
            if not depth:
                break
            depth -= 1
        elif kind == "join":
            if last is None or (token == "," and not depth):
                break
            joined = True
        elif kind == "string":
            quotes = 3 if token[:3] in ('"""', "\'\'\'") and len(token) >= 6 else 1
            spans.append((at + quotes, m.end() - quotes))
            words.append(token[quotes:-quotes])
            joined = False
        else:
            bare = token.rstrip(".:!?")
            call = text[m.end():m.end() + 1] == "("
            if token in constants:
                parts.append(constants[token])
            elif not call and not (words or parts or depth):
                spans.append((at, at + len(bare)))
                words.append(bare)
            joined = False
        at, last = m.end(), kind
        if kind != "join":
            end = at
    if not spans and not parts:
        return None, end
    return Value(spans, parts, "".join(words)), end


def assignments(text: str):
    """(name, Value) of the pairs in a text, constants followed; spans are those of the literals,
    wherever they stand."""
    constants, at = {}, 0
    while m := _HEAD.search(text, at):
        at = m.end()
        name = m["name"] or m["element"]
        if m["element"]:
            said = m["content"].strip()
            start = m.start("content") + m["content"].find(said) if said else m.end("content")
            value = Value([(start, start + len(said))], [], said) if said else None
        elif _BLOCK.match(text, at):
            spans, at = _block(text, m)
            value = Value(spans, [], "".join(text[a:b] for a, b in spans)) if spans else None
        else:
            value, at = _value(text, at, constants)
        if value:
            constants[name] = value
            yield name, value


def literal_spans(text: str) -> list:
    """Spans of the literals whose name and looks together reach the threshold."""
    if not any(c in text for c in "=:<"):
        return []
    found = set()
    for name, value in assignments(text):
        weight = sensitivity(name)
        if weight > 0 and weight + randomness(value) >= THRESHOLD:
            value.all_spans(found)
    return list(found)


def all_spans(text) -> tuple:
    """(base spans, all spans) in the order of their starts, then of the kinds.

    A literal inside a base span is not told a second time.
    """
    text = text or ""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=order)
    starts = [b[1] for b in base]
    ends = list(accumulate((b[2] for b in base), max))  # the farthest end of all up to each
    outside = lambda s: not (i := bisect_right(starts, s[1])) or ends[i - 1] < s[2]
    return base, sorted(base + [s for s in literal_spans(text) if outside(s)], key=order)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row for each row of ``docs``."""
    def make():
        def fn(batch):
            found = [all_spans(t) for t in batch["text"]]
            counts = [Counter(kind for kind, _, _ in base) for base, _ in found]
            return {
                "doc_id": batch["doc_id"],
                **{f"n_{k}": [c[k] for c in counts] for k in KINDS[:3]},
                "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found],
                "spans": [joined(s) for _, s in found],
            }

        return fn

    slim = docs.select("doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return map_texts(
        slim, make,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text, mark):
    """The text with a mark in the place of each stretch of spans that overlap or touch."""
    if text is None:
        return None
    out, end = [], 0
    for _, start, stop in all_spans(text)[1]:
        if start > end or not out:
            out += [text[end:start], mark]
        end = max(end, stop)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, mark="[SECRET]") -> DataFrame:
    """The rows of ``docs`` with all their columns; secrets in the text are replaced by ``mark``."""
    inner, outer = aside(docs)

    def make():
        def fn(batch):
            return batch | {"text": [redacted(t, mark) for t in batch["text"]]}

        return fn

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    return outer(map_texts(inner, make, kinds))
