"""Katz back-off language model over the whole corpus.

Bigram counts of the training documents are discounted by Good-Turing (counts up to
``MAX_DISCOUNTED``) and the mass set free goes to the unigram model with exactly normalised
back-off weights; unigrams back off in turn to one class of unknown words.

The corpus is cut into blocks of about ``BLOCK`` bytes of text. A block names each of its
words once, and each of its bigrams once, to the table partition that owns it; partitions
sum what all blocks name, and answer each block in the order it asked, so answers carry no
keys. Lists travel as compressed arrays. Counts of a frequent word's bigrams are dealt over
as many partitions as its frequency needs. Everything a task holds is one block or one
partition, both of bounded size; the driver sees counts of counts only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, crc_mod, small_batches
from .words import doc_ranges, mix, text_buffers, words

BLOCK = 2 << 20
PARTITION = 800_000  # expected entries of a table partition
MAX_DISCOUNTED = 5
_END = np.uint64(0x45F0C3D2E1B4A697)  # the end token's key
_R = MAX_DISCOUNTED + 1


def pack(a: np.ndarray, delta: bool = False) -> bytes:
    """An integer or float array, its byte planes apart, compressed."""
    a = np.diff(a, prepend=a.dtype.type(0)) if delta else a
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, dtype, delta: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    a = np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)
    return np.cumsum(a, dtype=dtype) if delta else a


def good_turing(n_r: list[int]) -> np.ndarray:
    """Discount ratios d_0 .. d_k from the numbers of types seen r = 1 .. k+1 times; d_0 is
    unused. Where Good-Turing gives no ratio in (0, 1), as when copies make a count of
    counts irregular, (r - 1/2) / r stands in."""
    d = np.ones(_R)
    n = [0, *n_r]
    common = _R * n[_R] / n[1] if n[1] else 1.0
    for r in range(1, _R):
        x = math.nan
        if n[r] and common < 1:
            x = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        d[r] = x if 0 < x < 1 else (r - 0.5) / r
    return d


class Unigrams:
    """p(w) for counted words and the class of unknown ones; sums to 1 over both."""

    def __init__(self, total: int, types: int, n_r: list[int]):
        self.total, self.types, self.d = total, types, good_turing(n_r)
        kept = total - sum((1 - self.d[r]) * r * n_r[r - 1] for r in range(1, _R))
        self.norm = total if kept < total else total + 1
        self.unknown = 1 - kept / self.norm if total else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        d = np.where(c < _R, self.d[np.minimum(c, _R - 1)], 1.0)
        return np.where(c > 0, d * c / max(1, self.norm), self.unknown)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


_BLOCKS = "block long, doc_ids array<long>, held binary, n_tokens binary, at binary, " \
          "keys binary, counts binary, n_keys long, tokens long"
_ASK = "bucket long, block long, keys binary, counts binary, extra binary"
_ANSWER = "bucket long, block long, a binary, b binary, n array<long>"
_SUMS = "bucket long, block long, a binary, b binary, n array<long>, ids binary, m binary, s binary"


def make_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents: every token as an index in the block's sorted word keys."""
    schema = _arrow(_BLOCKS)

    def run(batches):
        n = TaskContext.get().partitionId() << 33
        for batch in batches:
            b, off = text_buffers(batch.column("text"))
            ids, held_all = batch.column("doc_id"), np.array(batch.column("held").to_pylist(), bool)
            for i, j in doc_ranges(off, BLOCK):
                h, _, _, first = words(b[off[i] : off[j]], off[i : j + 1] - off[i])
                size = np.diff(first) + 1
                end = np.cumsum(size) - 1
                tok = np.empty(len(h) + j - i, np.uint64)
                is_end = np.zeros(len(tok), bool)
                is_end[end] = True
                tok[is_end], tok[~is_end] = _END, h
                keys, at = np.unique(tok, return_inverse=True)
                held = held_all[i:j]
                train = ~np.repeat(held, size)
                counts = np.bincount(at[train], minlength=len(keys))
                yield pa.RecordBatch.from_pylist([{
                    "block": n, "doc_ids": ids[i : i + j - i].to_pylist(), "held": held.tobytes(),
                    "n_tokens": pack(size.astype(np.int64)), "at": pack(at.astype(np.int32)),
                    "keys": pack(keys, True), "counts": pack(counts.astype(np.int64)),
                    "n_keys": len(keys), "tokens": len(tok)}], schema=schema)
                n += 1

    return docs.mapInArrow(run, _BLOCKS)


def _bucket_edges(n: int) -> np.ndarray:
    return np.array([(i << 64) // n for i in range(1, n)], np.uint64)


def _word_slices(keys: np.ndarray, n: int) -> np.ndarray:
    """Sorted word keys fall into buckets as slices."""
    return np.concatenate([[0], np.searchsorted(keys, _bucket_edges(n)), [len(keys)]])


def ask_words(blocks: DataFrame, n: int) -> DataFrame:
    schema = _arrow(_ASK)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                keys, counts = unpack(r["keys"], np.uint64, True), unpack(r["counts"], np.int64)
                cut = _word_slices(keys, n)
                yield pa.RecordBatch.from_pylist([
                    {"bucket": q, "block": r["block"], "keys": pack(keys[i:j], True),
                     "counts": pack(counts[i:j]), "extra": None}
                    for q, (i, j) in enumerate(zip(cut, cut[1:])) if j > i], schema=schema)

    return blocks.select("block", "keys", "counts").mapInArrow(run, _ASK)


def _gather(t: pa.Table):
    """All keys asked of a partition, once and sorted, and the sum of their counts."""
    rows = sorted(t.to_pylist(), key=lambda r: r["block"])
    keys = [unpack(r["keys"], np.uint64, True) for r in rows]
    uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
    given = np.concatenate([unpack(r["counts"], np.int64) for r in rows])
    total = np.bincount(at, weights=given, minlength=len(uniq)).astype(np.int64)
    cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    return rows, uniq, at, total, cut


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, _R + 1), minlength=_R + 2)[1 : _R + 1].tolist()


def count_words(asked: DataFrame) -> DataFrame:
    """Answers (a: counts, b: number among the partition's counted words, or -1), and for
    each partition a row without block: types, total, counts of counts."""
    schema = _arrow(_ANSWER)

    def run(t: pa.Table) -> pa.Table:
        rows, _, at, c, cut = _gather(t)
        rank = np.where(c > 0, np.cumsum(c > 0) - 1, -1)
        out = [{"bucket": r["bucket"], "block": r["block"], "a": pack(c[at[i:j]]),
                "b": pack(rank[at[i:j]]), "n": None} for r, i, j in zip(rows, cut, cut[1:])]
        out.append({"bucket": rows[0]["bucket"], "block": None, "a": None, "b": None,
                    "n": [int((c > 0).sum()), int(c.sum()), *_counts_of_counts(c)]})
        return pa.Table.from_pylist(out, schema=schema)

    return asked.groupBy("bucket").applyInArrow(run, _ANSWER)


class _Block:
    """A block with what its words' partitions answered."""

    def __init__(self, left: pa.Table, right: pa.Table, base: np.ndarray, n_types: int):
        r = left.to_pylist()[0]
        self.row, said = r, sorted(right.to_pylist(), key=lambda x: x["bucket"])
        self.said = [x for x in said if x["kind"] == 1]
        self.pairs = [x for x in said if x["kind"] == 2]
        self.weights = [x for x in said if x["kind"] == 3]
        c = np.concatenate([unpack(x["a"], np.int64) for x in self.said])
        ids = np.concatenate([np.where((v := unpack(x["b"], np.int64)) < 0, -1,
                                       v + base[x["bucket"]]) for x in self.said])
        at = unpack(r["at"], np.int32)
        self.size = unpack(r["n_tokens"], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.held = np.frombuffer(r["held"], bool)
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        self.at, self.c, self.w = at, c[at], ids[at]
        self.h = np.empty_like(self.w)
        self.h[1:] = self.w[:-1]
        self.h[self.first] = n_types  # the beginning of a text as history
        self.known = np.flatnonzero((self.w >= 0) & (self.h >= 0))
        self.key = (self.h[self.known].astype(np.uint64) * np.uint64(n_types + 1)
                    + self.w[self.known].astype(np.uint64))

    def history_counts(self, n_train: int) -> np.ndarray:
        c = np.empty_like(self.c)
        c[1:] = self.c[:-1]
        c[self.first] = n_train
        return c


def _pair_buckets(blk: _Block, n: int, per: float, n_train: int):
    """The block's bigrams, once: keys by partition and key, where each partition begins,
    and the place of each known token's bigram."""
    keys, first, inv = np.unique(blk.key, return_index=True, return_inverse=True)
    at = blk.known[first]
    spread = np.ceil(blk.history_counts(n_train)[at] / per).astype(np.uint64)
    spread = np.maximum(spread, np.uint64(1))
    home = mix(blk.h[at].astype(np.uint64)) + mix(blk.w[at].astype(np.uint64) + np.uint64(9)) % spread
    bucket = (home % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    cut = np.searchsorted(bucket[order], np.arange(n + 1))
    return keys[order], at[order], cut, place[inv]


def count_pairs(asked: DataFrame, uni: Unigrams, base: np.ndarray, n_types: int) -> DataFrame:
    """Answers (a: counts), and for each partition one row without block: counts of counts
    in n; for every history its successors seen 1 .. k times (m) and their unigram mass (s),
    dealt by the history's word partition."""
    schema = _arrow(_SUMS)
    empty = dict.fromkeys(schema.names)

    def run(t: pa.Table) -> pa.Table:
        rows, keys, at, c, cut = _gather(t)
        out = [{**empty, "bucket": r["bucket"], "block": r["block"], "a": pack(c[at[i:j]])}
               for r, i, j in zip(rows, cut, cut[1:])]
        cw = np.zeros(len(keys), np.int64)
        cw[at] = np.concatenate([unpack(r["extra"], np.int64) for r in rows])
        keys, cw, c = keys[c > 0], cw[c > 0], c[c > 0]
        out.append({**empty, "bucket": rows[0]["bucket"], "n": _counts_of_counts(c)})
        h = (keys // np.uint64(n_types + 1)).astype(np.int64)
        ids, i = np.unique(h, return_inverse=True)
        m = np.stack([np.bincount(i[c == r], minlength=len(ids)) for r in range(1, _R)], 1)
        s = np.bincount(i, weights=uni.p(cw), minlength=len(ids))
        word_bucket = np.searchsorted(base, ids, side="right") - 1
        for q in np.unique(word_bucket):
            own = word_bucket == q
            out.append({**empty, "bucket": -1 - int(q), "ids": pack(ids[own], True),
                        "m": pack(m[own].astype(np.int64).ravel()), "s": pack(s[own])})
        return pa.Table.from_pylist(out, schema=schema)

    return asked.groupBy("bucket").applyInArrow(run, _SUMS)


def _weight(d: np.ndarray, count: np.ndarray, m: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Back-off weights. A history that leaves no mass has its denominator raised by one;
    its weight is given negative to say so."""
    r = np.arange(1, _R)
    free = ((1 - d[1:]) * r * m).sum(1)
    none = free <= 1e-9
    mass = np.where(none, 1 / (count + 1), free / np.maximum(count, 1))
    w = mass / np.maximum(1e-300, 1 - s)
    return np.where(none, -w, w)


def score(docs: DataFrame, held: int = 1, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Learns from the documents whose crc32 of the id modulo ``folds`` is not ``held``, scores
    all, whole texts. Null and empty texts are the end token alone. Repeated rows count and
    are scored each. A null doc_id has the crc32 of an empty text. With nothing to learn
    from, every token is unknown: base scores are log10 of 0.5/0.5 and scores 0. An empty
    table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       (crc_mod(F.col("doc_id"), folds) == held).alias("held"))
    blocks = scratch.table(make_blocks(docs), "blocks")
    n_train = docs.where("not held").count()
    n_keys, tokens = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0)),
                                F.coalesce(F.sum("tokens"), F.lit(0))).first()
    nb1, nb2 = max(1, math.ceil(n_keys / PARTITION)), max(1, math.ceil(tokens / PARTITION))

    words_t = scratch.table(count_words(ask_words(blocks, nb1)), "words")
    stat = {r["bucket"]: r["n"] for r in words_t.where("block is null").select(
        "bucket", "n").collect()}  # a few numbers per partition
    per = np.array([stat.get(q, [0] * (_R + 2)) for q in range(nb1)], np.int64).reshape(nb1, -1)
    base = np.concatenate([[0], np.cumsum(per[:, 0])])[:-1]
    n_types, total = int(per[:, 0].sum()), int(per[:, 1].sum())
    uni = Unigrams(total, n_types, per[:, 2:].sum(0).tolist())
    share = max(1.0, float(PARTITION))

    body = blocks.select("block", "doc_ids", "held", "n_tokens", "at")
    kind = lambda df, k: df.where("block is not null").select(
        F.lit(k).alias("kind"), "block", "bucket", "a", "b")
    word_answers = kind(words_t, 1)

    ask_schema = _arrow(_ASK)

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        blk = _Block(left, right, base, n_types)
        keys, at, cut, place = _pair_buckets(blk, nb2, share, n_train)
        train = ~blk.held[blk.doc[blk.known]]
        counts = np.bincount(place[train], minlength=len(keys)).astype(np.int64)
        return pa.Table.from_pylist([
            {"bucket": q, "block": blk.row["block"], "keys": pack(keys[i:j], True),
             "counts": pack(counts[i:j]), "extra": pack(blk.c[at[i:j]])}
            for q, (i, j) in enumerate(zip(cut, cut[1:])) if j > i], schema=ask_schema)

    asked = body.groupBy("block").cogroup(word_answers.groupBy("block")).applyInArrow(ask, _ASK)
    pairs_t = scratch.table(count_pairs(asked, uni, np.append(base, n_types), n_types), "pairs")
    n_r = np.zeros(_R, np.int64)
    pair_stats = pairs_t.where("n is not null").agg(
        *[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(_R)]).first()
    d = good_turing([int(x) for x in (pair_stats or n_r)])

    sums = pairs_t.where("bucket < 0").select((-1 - F.col("bucket")).alias("bucket"),
                                              "ids", "m", "s")
    weight_schema = _arrow("bucket long, block long, a binary, b binary")

    def weights(t: pa.Table, parts: pa.Table) -> pa.Table:
        """The back-off weights of a word partition, in the order each block asked."""
        rows, parts = t.to_pylist(), parts.to_pylist()
        if not rows:  # the beginning of a text as history
            n, out = 1, [{"block": None, "b": pack(np.zeros(1, np.int64)),
                          "a": pack(np.array([n_train], np.int64))}]
            low, bucket = n_types, parts[0]["bucket"]
        else:
            bucket, out = rows[0]["bucket"], rows
            low = int(base[bucket])
            n = int(per[bucket, 0])
        count, m, s = np.zeros(n, np.int64), np.zeros((n, _R - 1), np.int64), np.zeros(n)
        for p in parts:
            i = unpack(p["ids"], np.int64, True) - low
            np.add.at(m, i, unpack(p["m"], np.int64).reshape(-1, _R - 1))
            np.add.at(s, i, unpack(p["s"], np.float64))
        for r in out:
            rank = unpack(r["b"], np.int64)
            count[rank[rank >= 0]] = unpack(r["a"], np.int64)[rank >= 0]
        w = np.append(_weight(d, count, m, s), 1.0)
        return pa.Table.from_pylist(
            [{"bucket": bucket, "block": r["block"], "a": pack(w[unpack(r["b"], np.int64)]),
              "b": None} for r in out], schema=weight_schema)

    weights_t = scratch.table(
        word_answers.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(
            weights, "bucket long, block long, a binary, b binary"), "weights")
    start = weights_t.where("block is null").select("a").first()
    start_w = float(unpack(bytes(start["a"]), np.float64)[0]) if start else 1.0

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        blk = _Block(left, right, base, n_types)
        _, _, cut, place = _pair_buckets(blk, nb2, share, n_train)
        c = np.concatenate([np.zeros(0, np.int64), *[unpack(x["a"], np.int64) for x in blk.pairs]])
        pair = np.zeros(len(blk.w), np.int64)
        pair[blk.known] = c[place]
        alpha = np.concatenate([unpack(x["a"], np.float64) for x in blk.weights])[blk.at]
        back = np.empty_like(alpha)
        back[1:] = alpha[:-1]
        back[blk.first] = start_w
        back[blk.h < 0] = 1.0
        hist = blk.history_counts(n_train) + (back < 0)
        seen = np.where(pair < _R, d[np.minimum(pair, _R - 1)], 1.0) * pair / np.maximum(hist, 1)
        p = np.where(pair > 0, seen, np.abs(back) * uni.p(blk.c))
        plain = np.log10((blk.c + 0.5) / (total + 0.5 * (n_types + 1)))
        n = len(blk.size)
        add = lambda v: np.bincount(blk.doc, weights=v, minlength=n)
        return pa.table({
            "doc_id": pa.array(blk.row["doc_ids"], pa.int64()), "held_out": blk.held,
            "n_tokens": blk.size, "n_known": add(blk.c > 0).astype(np.int64),
            "train_tokens": np.full(n, total), "base_score": add(plain),
            "score": add(np.log10(p))})

    answers = word_answers.unionByName(kind(pairs_t, 2)).unionByName(kind(weights_t, 3))
    return body.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        evaluate, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                  "train_tokens long, base_score double, score double")
