"""Personal data by anchor expansion.

An Aho-Corasick automaton finds short anchors in whole texts: at-signs, a digit on both
sides of a dot, two neighbouring digits, a plus before a digit, schemes, and words that
announce an identifier. From an anchor a parser of its kind walks left and right over the
characters that the kind allows, which gives the bounds, and checks what it found (parts of
an address, digit counts, check sums). Anchors come from left to right and no kind walks
back into its last span, so spans of a kind never overlap.

Base kinds, as patterns would find them leftmost and without overlap, failing ones dropped:
email, ip, card, phone. Added kinds: ``ipv6`` (a bracketed host after a scheme), ``iban``,
``ssn`` and ``account`` (after their cue words).
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from functools import cache
from string import ascii_letters, digits

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ipv6", "iban", "ssn", "account")
SCHEMES = ("://[",)
#: Words before an identifier, each also in upper case and with a capital.
CUES = {"iban": ("iban",), "ssn": ("ssn", "social security"),
        "account": ("account", "acct", "a/c")}
PIECE = 1 << 20  # characters that the automaton reads at a time

_LOCAL = frozenset(ascii_letters + digits + "._%+-")
_DIGITS = frozenset(digits)
_CARD = frozenset(digits + " -")
_run = lambda chars: re.compile(f"[{chars}]*").match  # noqa: E731  a walk to the right
_label, _number, _phone = _run("A-Za-z0-9-"), _run("0-9"), _run(r"\x20().0-9-")
_digit_chain = re.compile(r"[0-9](?:[\x20-]?[0-9])*").match
_alnum_chain = re.compile(r"[A-Za-z0-9](?:\x20?[A-Za-z0-9])*").match
_hex = _run("0-9A-Fa-f:.")
_gap = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|#|is))?\x20?[:=#-]?\x20?", re.IGNORECASE).match


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _back(text: str, at: int, least: int, allowed: frozenset) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


# A parser gets the text, the place and length of its anchor and the end of the last span of
# its kind. It returns (start, end, good); a span that is not good still ends the walk.


def _email(text: str, at: int, n: int, least: int):
    start, dot = _back(text, at, least, _LOCAL), _label(text, at + 1).end()
    end = 0
    if start < at and dot > at + 1:
        while text[dot : dot + 1] == "." and (stop := _label(text, dot + 1).end()) > dot + 1:
            end = dot = stop
    return (start, end, True) if end else None


def _ip(text: str, at: int, n: int, least: int):
    start = _back(text, at + 1, least, _DIGITS)
    end = _number(text, at).end()
    parts = [text[start:end]]
    while len(parts) < 4 and text[end : end + 1] == ".":
        stop = _number(text, end + 1).end()
        if stop == end + 1:
            break
        parts.append(text[end + 1 : stop])
        end = stop
    if start > at or len(parts) < 4:
        return None
    return start, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                           for p in parts)


def _card(text: str, at: int, n: int, least: int):
    end = _digit_chain(text, at).end()
    number = text[at:end].replace(" ", "").replace("-", "")
    return at, end, 13 <= len(number) <= 19 and luhn(number)


def _phone_number(text: str, at: int, n: int, least: int):
    end = _phone(text, at + 2).end()
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15


def _ipv6(text: str, at: int, n: int, least: int):
    start = at + n
    end = _hex(text, start).end()
    if text[end : end + 1] != "]":
        return None
    try:
        ipaddress.IPv6Address(text[start:end])
    except ValueError:
        return None
    return start, end, True


def _cued(text: str, at: int, n: int) -> int | None:
    """Where what a cue word announces may start; None if the cue is part of a word."""
    if at and text[at - 1].isalnum() or text[at + n : at + n + 1].isalpha():
        return None
    return _gap(text, at + n).end()


def _iban(text: str, at: int, n: int, least: int):
    start = _cued(text, at, n)
    m = _alnum_chain(text, start, start + 42) if start is not None else None
    if not m:
        return None
    chain = m.group()
    ends = [i + 1 for i, c in enumerate(chain) if c != " "]
    for k in range(min(34, len(ends)), 14, -1):  # the longest that the check sum accepts
        end = ends[k - 1]
        if start + end < len(text) and text[start + end].isalnum():
            continue
        v = chain[:end].replace(" ", "").upper()
        if v[:2].isalpha() and v[2:4].isdigit() and int("".join(
                str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1:
            return start, start + end, True
    return None


_ssn_shape = re.compile(r"([0-9]{3})[\x20-]?([0-9]{2})[\x20-]?([0-9]{4})(?![0-9])").match


def _ssn(text: str, at: int, n: int, least: int):
    start = _cued(text, at, n)
    m = _ssn_shape(text, start) if start is not None else None
    if not m or m[1] in ("000", "666") or m[1] >= "900" or m[2] == "00" or m[3] == "0000":
        return None
    return m.start(), m.end(), True


def _account(text: str, at: int, n: int, least: int):
    start = _cued(text, at, n)
    m = _digit_chain(text, start) if start is not None else None
    if not m or not 6 <= sum(c in _DIGITS for c in m.group()) <= 17:
        return None
    return m.start(), m.end(), True


PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone_number, "ipv6": _ipv6,
           "iban": _iban, "ssn": _ssn, "account": _account}


@cache
def _automaton() -> ahocorasick.Automaton:
    anchors = {"@": "email", **dict.fromkeys(SCHEMES, "ipv6")}
    for a in digits:
        anchors["+" + a] = "phone"
        for b in digits:
            anchors[f"{a}.{b}"] = "ip"
            anchors |= dict.fromkeys((a + b, f"{a} {b}", f"{a}-{b}"), "card")
    for kind, cues in CUES.items():
        for cue in cues:
            anchors |= dict.fromkeys((cue, cue.upper(), cue.capitalize()), kind)
    auto = ahocorasick.Automaton()
    for anchor, kind in anchors.items():
        auto.add_word(anchor, (kind, len(anchor)))
    auto.make_automaton()
    return auto


def anchors(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, place, length) of all anchors by the place where they end; the automaton reads
    ``PIECE`` characters at a time and a few before them."""
    auto, before = _automaton(), 16
    for lo in range(0, len(text), PIECE):
        base = max(0, lo - before)
        for end, (kind, n) in auto.iter(text[base : lo + PIECE]):
            if base + end >= lo:
                yield kind, base + end - n + 1, n


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    last = dict.fromkeys(KINDS, 0)
    out = []
    for kind, at, n in anchors(text):
        if at < last[kind] and kind not in ("email", "ip"):
            continue
        found = PARSERS[kind](text, at, n, last[kind])
        if found:
            start, end, good = found
            last[kind] = end
            if good:
                out.append((kind, start, end))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row, pii array<struct<kind,start,end>>) for every row; ``row`` is a struct of the
    columns ``keep`` (all). Places count code points, ends are exclusive.

    Null and empty texts have no spans. Repeated rows are returned each. An empty table
    gives an empty result.
    """
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"),
                       F.col("text").cast("string").alias("text"))
    span = T.StructType([T.StructField("kind", T.StringType()),
                         T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def one(batch: pa.RecordBatch):
        found = [spans(t.as_py() or "") for t in batch.column("text")]
        yield {"row": batch.column("row"),
               "pii": [[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found]}

    return map_arrow(rows, one, rows.select("row").schema.add("pii", T.ArrayType(span)))


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become
    one, named after the first."""
    if not text:
        return text
    out, done, merged = [], 0, []
    for kind, start, end in sorted(spans(text), key=lambda s: s[1:]):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, the personal data of their texts masked; columns unchanged."""
    def one(batch: pa.RecordBatch):
        yield {n: [mask(t.as_py()) for t in c] if n == "text" else c
               for n, c in zip(batch.schema.names, batch.columns)}

    return map_arrow(docs, one, docs.schema)


def evaluate(docs: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of every document."""
    d = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    text = lambda a: F.array_join(
        F.transform(a, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("pii", lambda s: s.kind.isin(*BASE))
    count = lambda k: F.size(F.filter("pii", lambda s: s.kind == k)).cast("long")
    return d.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text("pii").alias("spans"))
