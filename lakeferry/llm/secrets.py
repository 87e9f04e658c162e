"""Secret scans: fixed patterns, and formats inferred from what they find.

Values that the base patterns label as credentials train one probabilistic automaton per
kind: a prefix tree whose states are merged while a Hoeffding test finds their symbol and
end frequencies compatible (red-blue order). Two more automata learn from all other
credential-like strings, the short and the long. Every candidate of a text is then scored
by all automata; one that a kind's automaton explains as well as its own training values,
and far better than the automaton of other strings, is a secret too (kind ``learned``).
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, map_arrow, small_batches
from .words import LOWER, doc_ranges, text_buffers

KINDS = ("assign", "access", "hex")
LEARNED = "learned"
SHORT = "short"  # other strings under LONG characters
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of 32 or more: what is left of all runs
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SAMPLE_VALUES = 500  # training values of a kind, of all documents
MIN_LEN = 8  # of a value that a base pattern labels, so of a candidate
LONG = 16  # of the base patterns without a keyword, and of the long other strings
ALPHA = 0.05  # of the compatibility test
MARGIN = math.log(1000.0)  # by which a kind must beat the other strings

_DIGIT, _ALPHA = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = _ALPHA[65:91] = _ALPHA[97:123] = True
_CRED = np.zeros(256, bool)
_CRED[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_EDGE = "+/_.=-"


class Automaton:
    """Probabilistic automaton: transitions with counts, and end counts."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.to: list[dict[str, int]] = [{}]
        self.n: list[dict[str, int]] = [{}]
        self.end: list[int] = [0]
        for v, c in sorted(Counter(values).items()):
            q = 0
            for ch in v:
                if ch not in self.to[q]:
                    self.to[q][ch] = len(self.to)
                    self.to.append({})
                    self.n.append({})
                    self.end.append(0)
                self.n[q][ch] = self.n[q].get(ch, 0) + c
                q = self.to[q][ch]
            self.end[q] += c
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self.shortest = min(map(len, values), default=0)
        scores = sorted(self.rate(v) for v in values)
        self.least = scores[len(scores) // 100] if scores else math.inf

    def _total(self, q: int) -> int:
        return self.end[q] + sum(self.n[q].values())

    def _alike(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a == b:
                continue
            ta, tb = self._total(a), self._total(b)
            if not ta or not tb:
                continue
            gap = self._bound * (ta**-0.5 + tb**-0.5)
            if gap >= 1 and (ta <= 2 or tb <= 2):
                continue  # too little seen below either to tell them apart
            if abs(self.end[a] / ta - self.end[b] / tb) > gap:
                return False
            for ch in self.n[a].keys() | self.n[b].keys():
                if abs(self.n[a].get(ch, 0) / ta - self.n[b].get(ch, 0) / tb) > gap:
                    return False
                if ch in self.to[a] and ch in self.to[b]:
                    stack.append((self.to[a][ch], self.to[b][ch]))
        return True

    def _fold(self, into: int, q: int) -> None:
        """Adds the subtree of q, which nothing else leads to any more, to a state."""
        stack = [(into, q)]
        while stack:
            a, b = stack.pop()
            self.end[a] += self.end[b]
            for ch, c in self.n[b].items():
                self.n[a][ch] = self.n[a].get(ch, 0) + c
                if ch in self.to[a]:
                    stack.append((self.to[a][ch], self.to[b][ch]))
                else:
                    self.to[a][ch] = self.to[b][ch]

    def _merge_states(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = next(((p, ch, q) for p in red for ch, q in sorted(self.to[p].items())
                         if q not in known), None)
            if blue is None:
                break
            p, ch, q = blue
            for r in red:
                if self._alike(r, q):
                    self.to[p][ch] = r
                    self._fold(r, q)
                    break
            else:
                red.append(q)
        name = {q: i for i, q in enumerate(red)}
        self.to = [{ch: name[x] for ch, x in self.to[q].items()} for q in red]
        self.n = [self.n[q] for q in red]
        self.end = [self.end[q] for q in red]

    def log_likelihood(self, v: str) -> float:
        q, out = 0, 0.0
        for ch in v:
            if ch not in self.to[q]:
                return -math.inf
            out += math.log(self.n[q][ch] / self._total(q))
            q = self.to[q][ch]
        return out + math.log(self.end[q] / self._total(q)) if self.end[q] else -math.inf

    def smoothed(self, v: str) -> float:
        """As log_likelihood, but a step never seen costs a chance of 1/1000 and starts
        over: what the strings without a format leave possible."""
        q, out = 0, 0.0
        for ch in v:
            seen = self.n[q].get(ch, 0)
            out += math.log(max(0.001, seen / max(1, self._total(q))))
            q = self.to[q][ch] if seen else 0
        return out

    def rate(self, v: str) -> float:
        return self.log_likelihood(v) / (len(v) + 1)

    def dump(self) -> str:
        return json.dumps({"to": self.to, "n": self.n, "end": self.end, "least": self.least,
                           "shortest": self.shortest})

    @staticmethod
    def load(text: str) -> Automaton:
        a = Automaton.__new__(Automaton)
        a.__dict__.update(json.loads(text))
        return a


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the base patterns, sorted."""
    out = [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_LEN]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LONG]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def _candidates(text: str, runs: list[tuple[int, int]], spans) -> list[tuple[int, int]]:
    """Runs without edge punctuation, long enough, with letter and digit, clear of spans."""
    out = []
    for s, e in runs:
        v = text[s:e]
        s += len(v) - len(v.lstrip(_EDGE))
        v = v.strip(_EDGE)
        e = s + len(v)
        if (len(v) >= MIN_LEN and any(c.isdigit() for c in v) and any(c.isalpha() for c in v)
                and all(e <= x[0] or x[2] <= s for x in spans)):
            out.append((s, e))
    return out


def _texts(batch: pa.RecordBatch, least: int = MIN_LEN):
    """(row, text, credential-like runs) of the texts that can hold a match or a candidate
    of ``least`` characters. Bytes are looked over at once; only these few texts are
    decoded. Runs under ``LONG`` are candidates with a letter and a digit only."""
    b, off = text_buffers(batch.column("text"))
    for i, j in doc_ranges(off):
        p, o = b[off[i] : off[j]], off[i : j + 1] - off[i]
        if not len(p):
            continue
        edge = np.zeros(len(p) + 1, bool)
        edge[o] = True
        inside = _CRED[p]
        starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]))
        ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
        some = ends - starts >= least
        starts, ends = starts[some], ends[some]
        some = ends - starts >= LONG
        if least < LONG:
            digits, letters = (np.concatenate([[0], np.cumsum(x[p], dtype=np.int32)])
                               for x in (_DIGIT, _ALPHA))
            some |= (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
        starts, ends = starts[some], ends[some]
        runs: dict[int, list[tuple[int, int]]] = {}
        for d, s, e in zip(np.searchsorted(o, starts, side="right") - 1, starts, ends):
            runs.setdefault(int(d), []).append((int(s - o[d]), int(e - o[d])))
        low, want = LOWER[p].tobytes(), set(runs)
        for word in _KEYWORDS:
            at = low.find(word)
            while at >= 0:
                d = int(np.searchsorted(o, at, side="right")) - 1
                want.add(d)
                at = low.find(word, max(at + 1, int(o[d + 1]) - len(word) + 1))
        raw = p.tobytes()
        for d in sorted(want):
            data = raw[o[d] : o[d + 1]]
            text = data.decode("utf-8", "replace")
            if len(text) == len(data):
                yield i + d, text, runs.get(d, [])
            else:
                yield i + d, text, [(len(data[:s].decode("utf-8", "replace")),
                                     len(data[:e].decode("utf-8", "replace")))
                                    for s, e in runs.get(d, [])]


def _hash(value: str) -> int:
    h = hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(h, "big", signed=True)


def _bottom(values: dict[str, int]) -> dict[str, int]:
    return dict(sorted(values.items(), key=lambda x: (x[1], x[0]))[:SAMPLE_VALUES])


def learn(docs: DataFrame) -> dict[str, Automaton]:
    """Automata of the kinds and of other strings, from all documents: the
    ``SAMPLE_VALUES`` distinct values of each kind that are smallest by hash. Every task
    passes on as many of a kind at most."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("h", pa.int64())])

    def run(batches):
        best: dict[str, dict[str, int]] = {}

        def add(kind: str, value: str) -> None:
            of = best.setdefault(kind, {})
            if value not in of:
                of[value] = _hash(value)
                if len(of) >= 4 * SAMPLE_VALUES:
                    best[kind] = _bottom(of)

        for batch in batches:
            for _, text, runs in _texts(batch):
                spans = base_spans(text)
                for x in spans:
                    add(KINDS[x[1]], x[3])
                for s, e in _candidates(text, runs, spans):
                    add(LEARNED if e - s >= LONG else SHORT, text[s:e])
        out = [(k, v, h) for k in best for v, h in _bottom(best[k]).items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 3, schema)],
            schema=schema)

    values = docs.select("text").mapInArrow(
        lean(run), "kind string, value string, h long").distinct()
    first = Window.partitionBy("kind").orderBy("h", "value")
    values = values.withColumn("i", F.row_number().over(first)).where(F.col("i") <= SAMPLE_VALUES)

    def train(t: pa.Table) -> pa.Table:
        return pa.table({"kind": t["kind"][:1].cast(pa.string()), "model": pa.array(
            [Automaton(sorted(t["value"].to_pylist())).dump()], pa.string())})

    models = values.groupBy("kind").applyInArrow(train, "kind string, model string")
    return {r["kind"]: Automaton.load(r["model"]) for r in models.collect()}


def shortest(models: dict[str, Automaton]) -> int:
    """Length of the shortest value that a kind was trained on: candidates have it at least."""
    return min((models[k].shortest for k in KINDS if k in models), default=LONG)


def all_spans(text: str, runs, models: dict[str, Automaton]) -> list[tuple[int, int, int, str]]:
    spans = base_spans(text)
    found = []
    for s, e in _candidates(text, runs, spans):
        v = text[s:e]
        other = models.get(LEARNED if len(v) >= LONG else SHORT)
        chance = other.smoothed(v) if other else len(v) * math.log(1 / 64)
        for kind in KINDS:
            m = models.get(kind)
            if m and len(v) >= m.shortest and m.rate(v) >= m.least and m.log_likelihood(v) >= chance + MARGIN:
                found.append((s, len(KINDS), e, v))
                break
    return sorted(spans + found)


def _joined(spans) -> str:
    return ",".join(f"{(*KINDS, LEARNED)[k]}:{s}:{e}" for s, k, e, _ in spans)


def scan(docs: DataFrame, models: dict[str, Automaton] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``.

    Null and empty texts have no spans (the hash of an empty text). Repeated rows are
    scanned each; a null doc_id stays null; other columns are ignored; an empty table gives
    an empty result. ``models`` are learned from ``docs`` unless given.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    models = learn(docs) if models is None else models
    least = min(LONG, shortest(models))

    def one(batch: pa.RecordBatch):
        n = batch.num_rows
        counts, joined = np.zeros((n, 3), np.int64), [""] * n
        sha = [hashlib.sha256(b"").hexdigest()] * n
        for i, text, runs in _texts(batch, least):
            spans = all_spans(text, runs, models)
            base = [x for x in spans if x[1] < 3]
            counts[i] = np.bincount([x[1] for x in base], minlength=3)
            sha[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
            joined[i] = _joined(spans)
        yield {"doc_id": batch.column("doc_id"), "n_assign": counts[:, 0], "n_access": counts[:, 1],
               "n_hex": counts[:, 2], "base_sha256": sha, "spans": joined}

    return map_arrow(docs, one, "doc_id long, n_assign long, n_access long, n_hex long, "
                                "base_sha256 string, spans string")


def redact(docs: DataFrame, models: dict[str, Automaton] | None = None,
           mask: str = "[SECRET]") -> DataFrame:
    """Rows of ``docs``, columns unchanged, with every span of a text replaced by ``mask``
    (spans that overlap become one). ``n_chars``, if there, follows the new text."""
    models = learn(docs.select("doc_id", "text")) if models is None else models
    least = min(LONG, shortest(models))
    has_chars = "n_chars" in docs.columns
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            text, chars = batch.column("text"), {}
            pieces, done = [], 0  # only texts with a span become Python strings
            for i, t, runs in _texts(batch, least):
                parts, at = [], 0
                for s, _, e, _ in all_spans(t, runs, models):
                    if s >= at:
                        parts += [t[at:s], mask]
                    at = max(at, e)
                if parts:
                    new = "".join(parts) + t[at:]
                    pieces += [text.slice(done, i - done), pa.array([new], text.type)]
                    done, chars[i] = i + 1, len(new)
            if pieces:
                cols = dict(zip(batch.schema.names, batch.columns))
                cols["text"] = pa.concat_arrays([*pieces, text.slice(done)])
                if has_chars:
                    n = cols["n_chars"]
                    cols["n_chars"] = pa.array([chars.get(i, x) for i, x in enumerate(
                        n.to_pylist())], n.type)
                batch = pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
            yield batch

    return docs.mapInArrow(lean(run), docs.schema)
