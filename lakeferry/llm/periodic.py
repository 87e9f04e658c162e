"""Periodic run detection by online dyadic square catching.

A run is a stretch of words with a smallest period q, at least four periods and six words
long, that no neighbouring word extends. Words are appended from left to right. For every
power of two m a catcher is set on every window of m words that two adjacent completed
blocks of m/2 words fill (on each word for m = 1). Every appended word ends one window of m
words, and this window is compared with the one catcher that lies between m/2 + 1 and m
words before it. Equal windows at a distance d <= m are a square: two equal halves of d
words each. A run whose period lies in (m/2, m] holds a catcher and its copy one period
later, whatever its place, and no copy comes sooner, so every catcher reports its first
square only and no run is missed. Squares of one period that overlap belong to one run;
extended word by word to both sides they give its ends. Of runs with the same ends the
smallest period counts.

All words of an appended piece advance their comparisons together, one level after the
other: about one comparison per word and level, levels up to a quarter of the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow
from .words import _cuts, doc_ranges, mix, text_buffers

MIN_PERIODS, MIN_WORDS = 4, 6
PIECE_WORDS = 1 << 16
_K = np.uint64(0x9E3779B97F4A7C15)


class SquareCatchers:
    """Catchers over a growing sequence of word numbers (64-bit integers)."""

    def __init__(self, longest: int):
        """``longest``: no run is longer than this many words."""
        self.levels = [1]
        while self.levels[-1] < longest // MIN_PERIODS:
            self.levels.append(2 * self.levels[-1])
        # of every level: the first window kept, and the hashes of the windows from there on
        self.kept = [(0, np.zeros(0, np.uint64)) for _ in self.levels]
        self.last = [-1] * len(self.levels)  # the catcher that reported last
        self.squares: list[np.ndarray] = []  # rows of (period, first word, words)

    def append(self, words: np.ndarray) -> None:
        new = mix(words.astype(np.uint64) * _K + _K)
        for at, m in enumerate(self.levels):
            base, old = self.kept[at]
            first = base + len(old)  # the first window that this piece completes
            h = np.concatenate([old, new])
            self._compare(at, m, base, first, h)
            # windows of twice the length: two of this level, m words apart
            start = max(0, first - m)
            left = h[start - base : max(start - base, len(h) - m)]
            right = h[start - base + m :]
            new = mix(left * _K + right)
            drop = max(0, len(h) - 2 * m)
            self.kept[at] = (base + drop, h[drop:])

    def _compare(self, at: int, m: int, base: int, first: int, h: np.ndarray) -> None:
        s = np.arange(max(first, 1), base + len(h))
        step = max(1, m // 2)
        b = s - 1 if m == 1 else ((s - 1) // step - 1) * step
        hit = (b > self.last[at]) & (h[s - base] == h[np.maximum(b, 0) - base])
        if not hit.any():
            return
        b, nearest = np.unique(b[hit], return_index=True)
        d = s[hit][nearest] - b
        self.last[at] = int(b[-1])
        self.squares.append(np.stack([d, b, d + m], 1))

    def runs(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs of the whole sequence, by start, period."""
        if not self.squares:
            return []
        sq = np.concatenate(self.squares)
        sq = sq[np.lexsort((sq[:, 1], sq[:, 0]))]
        q, lo, hi = sq[:, 0], sq[:, 1], sq[:, 1] + sq[:, 2]
        # squares of one period that overlap by a period at least are of one run
        joined = np.zeros(len(sq), bool)
        joined[1:] = (q[1:] == q[:-1]) & (hi[:-1] - lo[1:] >= q[1:])
        heads = np.flatnonzero(~joined)
        ends: dict[tuple[int, int], int] = {}
        reached = (0, 0)
        for i, last in zip(heads, np.append(heads[1:], len(sq)) - 1):
            p = int(q[i])
            if reached[0] == p and hi[last] <= reached[1]:
                continue  # inside the run found last
            x, y = self._extend(words, p, int(lo[i]), int(hi[last]))
            reached = (p, y)
            if y - x >= max(MIN_WORDS, MIN_PERIODS * p):
                ends[x, y] = min(p, ends.get((x, y), p))
        return sorted((x, y - x, p) for (x, y), p in ends.items())

    @staticmethod
    def _extend(words: np.ndarray, p: int, lo: int, hi: int) -> tuple[int, int]:
        """Ends of the longest stretch about the square at ``lo`` with words p apart equal
        (an empty one if the square's hashes lied)."""
        if not np.array_equal(words[lo : lo + p], words[lo + p : lo + 2 * p]):
            return lo, lo
        step, at = 64, lo
        while at + p < len(words):
            n = min(step, len(words) - p - at)
            differ = np.flatnonzero(words[at : at + n] != words[at + p : at + p + n])
            if len(differ):
                at += int(differ[0])
                break
            at, step = at + n, step * 2
        end, step, at = at + p, 64, lo
        while at > 0:
            n = min(step, at)
            differ = np.flatnonzero(words[at - n : at] != words[at - n + p : at + p])
            if len(differ):
                at -= n - 1 - int(differ[-1])
                break
            at, step = at - n, step * 2
        return at, end


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    catchers = SquareCatchers(len(words) if longest is None else longest)
    for i in range(0, len(words), PIECE_WORDS):
        catchers.append(words[i : i + PIECE_WORDS])
    return catchers.runs(words)


def repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _numbered(b: np.ndarray, vocab: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers of ``vocab``, which grows; a piece of it at a time."""
    out = []
    for lo, hi in zip(cuts := _cuts(b), cuts[1:]):
        ws = b[lo:hi].tobytes().split()
        out.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in ws), np.int64, len(ws)))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _batch(batch: pa.RecordBatch, rewrite: Callable | None) -> Iterator[dict]:
    b, off = text_buffers(batch.column("text"))
    keys = batch.column("key").to_pylist()
    for i, j in doc_ranges(off):
        vocab: dict[bytes, int] = {}
        docs = []
        for r in range(i, j):
            w = _numbered(b[off[r] : off[r + 1]], vocab)
            docs.append(rewrite(keys[r], w) if rewrite and len(w) else w)
        # one sequence of all texts, a word of its own between them: no square crosses it
        stream = np.concatenate([np.append(w, -1 - n) for n, w in enumerate(docs)])
        first = np.cumsum([0, *(len(w) + 1 for w in docs)])
        found: list[list] = [[] for _ in docs]
        for start, length, q in find_runs(stream, max(map(len, docs))):
            n = int(np.searchsorted(first, start, side="right")) - 1
            found[n].append((start - int(first[n]), length, q))
        names = list(vocab)
        texts = []
        for w, runs in zip(docs, found):
            kept = w[~repeats(len(w), runs)] if runs else w
            texts.append(b" ".join(map(names.__getitem__, kept.tolist())))
        yield {"row": batch.column("row").slice(i, j - i), "n_words": [len(w) for w in docs],
               "runs": [[dict(zip(("start", "length", "period"), r)) for r in rs]
                        for rs in found],
               "collapsed": pa.array(texts, pa.binary()).cast(pa.string())}


def collapse(docs: DataFrame, keep: list[str] | None = None, key: str | None = None,
             rewrite: Callable | None = None) -> DataFrame:
    """(row, n_words, runs array<struct<start,length,period>>, collapsed) for every row;
    ``row`` is a struct of the columns ``keep`` (all). ``collapsed`` is the text without the
    words that some run holds after its first period, the others joined by one space.

    Words are numbered from 0; they are the stretches of bytes other than 0x20 and
    0x09-0x0D. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. Repeated rows are returned each. An empty table gives an empty result. ``rewrite``
    takes the value of column ``key`` and the word numbers of a text and returns others of
    the same text.
    """
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col("text").cast("string").alias("text"),
                       (F.col(key) if key else F.lit(None).cast("long")).alias("key"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = rows.select("row").schema.add("n_words", "long").add(
        "runs", T.ArrayType(run)).add("collapsed", "string")
    return map_arrow(rows, lambda batch: _batch(batch, rewrite), schema)


def planted_period(doc_id: int | None, w: np.ndarray) -> np.ndarray:
    """One text in ten made periodic from a word on, both chosen by the crc32 of its id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([w[:a], w[a + np.arange(n - a) % p]])


def evaluate(docs: DataFrame) -> DataFrame:
    """The runs of every document, one text in ten made periodic first (``planted_period``;
    a null doc_id never), as counts, the longest run and digests."""
    d = collapse(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"],
                 "doc_id", planted_period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return d.withColumn("best", best).select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        digest(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"), "n_words")
