"""Quality rules as a short-circuit cascade.

Every rule rejects a document or lets it pass, and a document is kept if all let it pass,
so the order changes the cost only, never the verdict. ``order_rules`` times every rule and
counts its rejections on a sample and sorts the rules by rejections per second; ``judge``
then runs each rule only on the documents that all rules before it let pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .words import SPACE, doc_ranges, mix, text_buffers, words

SAMPLE_ROWS = 2000  # expected rows of the sample that the rules are timed on

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


class Texts:
    """Counts over a range of texts; what a rule needs beyond the base is made on demand."""

    def __init__(self, b: np.ndarray, off: np.ndarray):
        self.b, self.off, self.n = b, off, len(off) - 1
        self.h, self.s, self.e, self.first = words(b, off, lower=False)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.n_words)

    def _per_doc(self, mark: np.ndarray) -> np.ndarray:
        c = np.zeros(len(mark) + 1, np.int64)
        np.cumsum(mark, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._per_doc(((self.b & 0xC0) != 0x80) & ~SPACE[self.b])

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_doc(_SYMBOL[self.b])

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        raw, full, dup = self.b.tobytes(), np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for i in np.flatnonzero(self.n_words):
            lines = [x for x in raw[self.off[i] : self.off[i + 1]].split(b"\n") if x.strip()]
            full[i], dup[i] = len(lines), len(lines) - len(set(lines))
        return full, dup

    @property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        h, out = self.h, np.zeros(self.n, np.int64)
        if len(h) < 3:
            return out
        at = np.flatnonzero(self.doc[2:] == self.doc[:-2])
        w = mix(h[at] * np.uint64(3) + mix(h[at + 1] * np.uint64(5) + mix(
            h[at + 2] + self.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
        order = np.argsort(w)
        same = w[order][1:] == w[order][:-1]
        twice = np.zeros(len(w), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        mark = np.zeros(len(h), bool)
        for j in range(3):
            mark[at[twice] + j] = True
        return np.bincount(self.doc[mark], minlength=self.n)

    def lettered(self, i: np.ndarray) -> np.ndarray:
        """Words with a letter A-Z or a character beyond ASCII."""
        c = np.zeros(len(self.b) + 1, np.int64)
        np.cumsum(_LETTER[self.b], out=c[1:])
        return np.bincount(self.doc[c[self.e] > c[self.s]], minlength=self.n)[i]

    def word_counts(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words, and the count of the most frequent one, of the chosen texts."""
        distinct, top = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for q, d in enumerate(i):
            if self.n_words[d]:
                _, c = np.unique(self.h[self.first[d] : self.first[d + 1]], return_counts=True)
                distinct[q], top[q] = len(c), c.max()
        return distinct, top


Rule = Callable[[Texts, np.ndarray], np.ndarray]

#: Each rule gets the texts and the indexes of those still kept, and marks what it rejects.
RULES: dict[str, Rule] = {
    "symbols": lambda t, i: 2 * t.n_symbols[i] > t.n_words[i],
    "word_length": lambda t, i: (t.word_chars[i] < 2 * t.n_words[i])
    | (t.word_chars[i] > 15 * t.n_words[i]),
    "repeated_lines": lambda t, i: 2 * t.n_dup_lines[i] > t.n_lines[i],
    "few_letters": lambda t, i: 10 * t.lettered(i) < 6 * t.n_words[i],
    "few_distinct": lambda t, i: 50 * t.word_counts(i)[0] < t.n_words[i],
    "one_word": lambda t, i: 10 * t.word_counts(i)[1] > 4 * t.n_words[i],
}


def _ranges(batch: pa.RecordBatch):
    b, off = text_buffers(batch.column("text"))
    for i, j in doc_ranges(off):
        yield Texts(b[off[i] : off[j]], off[i : j + 1] - off[i])


def _base_failed(t: Texts) -> np.ndarray:
    return (t.n_words < 50) | (100 * t.n_repeat_words > 50 * t.n_words)


def order_rules(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second of cost, highest first, measured on an expected
    ``sample_rows`` rows chosen by a hash of the id."""
    n = docs.count()
    if not n:
        return list(RULES)
    share = min(1.0, sample_rows / n)

    def one(batch: pa.RecordBatch):
        cost, gone = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0)
        for t in _ranges(batch):
            i = np.flatnonzero(~_base_failed(t))
            for name, rule in RULES.items():
                fresh = Texts.__new__(Texts)
                fresh.__dict__.update({k: t.__dict__[k] for k in
                                       ("b", "off", "n", "h", "s", "e", "first", "n_words", "doc")})
                began = time.perf_counter()
                gone[name] += int(rule(fresh, i).sum())
                cost[name] += time.perf_counter() - began
        yield {"rule": list(RULES), "cost": [cost[r] for r in RULES],
               "gone": [gone[r] for r in RULES]}

    u = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    seen = map_arrow(docs.where(u).select("text"), one, "rule string, cost double, gone long")
    rows = seen.groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("gone").alias("gone"))
    rate = {r["rule"]: (r["gone"] + 1) / (r["cost"] + 1e-6) for r in rows.collect()}
    return sorted(RULES, key=lambda r: -rate.get(r, 0.0))


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept) for every row of ``docs``, whole texts.

    Null and empty texts: no words, base_failed, not kept. A null doc_id stays null.
    Repeated rows are judged one by one; other columns are ignored; an empty table gives an
    empty result. ``order`` is measured on ``docs`` itself unless given.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    order = order_rules(docs) if order is None else order
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def one(batch: pa.RecordBatch):
        cols: dict[str, list] = {c: [] for c in (*counts, "base_failed", "kept")}
        for t in _ranges(batch):
            failed = _base_failed(t)
            kept = ~failed
            for name in order:
                i = np.flatnonzero(kept)
                if not len(i):
                    break
                kept[i[RULES[name](t, i)]] = False
            for c in counts:
                cols[c].append(getattr(t, c))
            cols["base_failed"].append(failed)
            cols["kept"].append(kept)
        yield {"doc_id": batch.column("doc_id")} | {
            c: np.concatenate(v) if v else [] for c, v in cols.items()}

    return map_arrow(docs, one, "doc_id long, " + ", ".join(f"{c} long" for c in counts)
                     + ", base_failed boolean, kept boolean")


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                              lambda x: x <> '') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
t AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM t)
          WHERE c >= 2),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) AS s(j) GROUP BY doc_id),
tops AS (SELECT doc_id, max(c) AS top, count(*) AS distinct_words FROM
           (SELECT doc_id, x, count(*) AS c FROM w, unnest(ws) AS u(x) GROUP BY doc_id, x)
         GROUP BY doc_id),
base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
                len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered,
                coalesce(top, 0) AS top, coalesce(distinct_words, 0) AS distinct_words
         FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN tops USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 2 * n_symbols <= n_words AND word_chars >= 2 * n_words
         AND word_chars <= 15 * n_words AND 2 * n_dup_lines <= n_lines
         AND 10 * lettered >= 6 * n_words AND 50 * distinct_words >= n_words
         AND 10 * top <= 4 * n_words AS kept
FROM f
"""
