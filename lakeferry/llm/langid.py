"""Language ID by language-bitmask n-gram filters.

A Bloom filter whose cells are bit masks, one bit per language: the AND of a few cells of
an n-gram gives all languages that contain it at once. A text's n-grams are counted per
language (a popcount of each bit over its positions), the counts are corrected for the
false positives of each language's filter, and the highest corrected count decides. Its
share of all n-grams of the text, the coverage, is the score.

The filter is fitted on an expected ``SAMPLE_PER_LANG`` labelled documents per language.
It has ``CELLS`` cells of one word for each ``BITS`` languages, which bounds what is
broadcast by the number of languages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, lean, map_arrow, small_batches
from .words import LOWER, doc_ranges, mix, text_buffers

SAMPLE_PER_LANG = 2000
BITS = 64  # languages in a word of a cell
GRAM = 5  # bytes of an n-gram
CELLS = 1 << 20
PROBES = 2
#: An n-gram is learned from this share of all n-grams of its language on (once, in a small
#: language; about five times in a full sample), so a language of few texts learns too.
MIN_RATE = 1e-6
#: An n-gram counts for a language if its rate there is at least this share of its highest.
MIN_SHARE = 0.25
#: A language explains a text that it covers by this share of the median over its own texts.
LEVEL = 0.5
_PIECE = 1 << 18


def _grams(b: np.ndarray) -> np.ndarray:
    """Hash of the n-gram that begins at each byte, A-Z lower-cased."""
    b = LOWER[b].astype(np.uint64)
    n = len(b) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = b[:n].copy()
    for j in range(1, GRAM):
        x <<= np.uint64(8)
        x |= b[j : j + n]
    return mix(x + np.uint64(1))


def _cells(h: np.ndarray) -> list[np.ndarray]:
    return [(h >> np.uint64(21 * p)) & np.uint64(CELLS - 1) for p in range(PROBES)]


def _padded(b: np.ndarray, off: np.ndarray):
    """Texts with a space before and after, in pieces: (text index, bytes). A piece of a
    long text begins GRAM - 1 bytes before the end of the last, so no n-gram is missed."""
    for d in range(len(off) - 1):
        t = np.concatenate([[32], b[off[d] : off[d + 1]], [32]]).astype(np.uint8)
        for i in range(0, max(1, len(t) - GRAM + 1), _PIECE):
            yield d, t[i : i + _PIECE + GRAM - 1]


class Model:
    """Cells, the languages of the bits, the false-positive rate of each, and the coverage
    from which on each explains a text. Word w of the cells holds languages 64 w on."""

    def __init__(self, cells: np.ndarray, langs: list[str]):
        self.langs = langs
        kind = np.uint8 if len(langs) <= 8 else np.uint64
        self.cells = np.atleast_2d(cells).astype(kind)
        fill = [float(((self.cells[k // BITS] >> kind(k % BITS)) & kind(1)).mean())
                for k in range(len(langs))]
        self.false_rate = np.array([f**PROBES for f in fill])
        self.level = np.zeros(len(langs))

    def counts(self, h: np.ndarray) -> np.ndarray:
        at = [c.astype(np.int64) for c in _cells(h)]
        out = []
        for w, cells in enumerate(self.cells):
            m = cells[at[0]]
            for c in at[1:]:
                m &= cells[c]
            k = min(BITS, len(self.langs) - BITS * w)
            if m.dtype == np.uint8:
                bits = (np.arange(256)[:, None] >> np.arange(k)) & 1
                out.append(np.bincount(m, minlength=256) @ bits)
            else:
                out.append(np.array([((m >> np.uint64(b)) & np.uint64(1)).sum()
                                     for b in range(k)], np.int64))
        return np.concatenate(out)

    def coverage(self, hits: np.ndarray, n: int) -> np.ndarray:
        """Share of n n-grams that each language has, without its false positives."""
        true = np.maximum(0.0, (hits - n * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        return np.minimum(1.0, true / max(1, n))

    def decide(self, share: np.ndarray) -> tuple[str, float]:
        if not self.langs:
            return "und", 0.0
        k = int(share.argmax())
        return self.langs[k], float(share[k])


def fit(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learn from text and lang of ``docs``; rows without either are left out. Rows of a
    language beyond ``sample_per_lang`` are thinned by a hash of the id to that expected
    number; there may be any number of languages."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    n = rows.groupBy("lang").count().orderBy("lang").collect()
    langs = [r["lang"] for r in n]
    if not langs:
        return Model(np.zeros(CELLS, np.uint64), [])
    share = F.create_map(*[x for r in n for x in (
        F.lit(r["lang"]), F.lit(min(1.0, sample_per_lang / r["count"])))])[F.col("lang")]
    u = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(u < share)

    def one(batch: pa.RecordBatch):
        b, off = text_buffers(batch.column("text"))
        lang = batch.column("lang").to_pylist()
        for i, j in doc_ranges(off):
            by: dict[str, list] = {}
            for d, piece in _padded(b, off[i : j + 1]):
                by.setdefault(lang[i + d], []).append(_grams(piece))
            for k, hs in by.items():
                g, c = np.unique(np.concatenate(hs), return_counts=True)
                yield {"gram": g.view(np.int64), "lang": [k] * len(g), "n": c}

    grams = map_arrow(sample, one, "gram long, lang string, n long").groupBy("gram", "lang").agg(
        F.sum("n").alias("n"))
    total = {r["lang"]: r["n"] for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    number = F.create_map(*[x for k, v in enumerate(langs) for x in (
        F.lit(v), F.lit(k))])[F.col("lang")]
    n_words = -(-len(langs) // BITS)
    rate = F.col("n") / F.create_map(*[x for v in langs for x in (
        F.lit(v), F.lit(float(total.get(v, 1))))])[F.col("lang")]
    many = grams.withColumn("rate", rate).where(F.col("rate") >= MIN_RATE).withColumn("k", number)
    top = many.groupBy("gram").agg(F.max("rate").alias("top"),
                                   F.collect_list(F.struct("rate", "k")).alias("r"))
    has = F.transform(F.filter("r", lambda x: x["rate"] >= MIN_SHARE * F.col("top")),
                      lambda x: x["k"])

    def place(batch: pa.RecordBatch):
        h = batch.column("gram").to_numpy().view(np.uint64)
        has = batch.column("has")
        row = np.repeat(np.arange(len(h)), has.value_lengths().to_numpy())
        k = has.flatten().to_numpy().astype(np.int64)
        masks = np.zeros((n_words, len(h)), np.uint64)
        np.bitwise_or.at(masks, (k // BITS, row), np.uint64(1) << (k % BITS).astype(np.uint64))
        word, at = np.nonzero(masks)
        for c in _cells(h):
            yield {"cell": c[at].astype(np.int64), "word": word,
                   "mask": masks[word, at].view(np.int64)}

    cells = map_arrow(top.select("gram", has.alias("has")), place, "cell long, word long, mask long")
    got = cells.groupBy("cell", "word").agg(  # CELLS rows a word at most
        F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros((n_words, CELLS), np.uint64)
    table[got["word"].to_numpy(), got["cell"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    model = Model(table, langs)

    # the level of a language: what it covers of its own texts
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def own(batch: pa.RecordBatch):
        at = {v: k for k, v in enumerate(shared.value.langs)}
        lang, (share, _) = batch.column("lang").to_pylist(), _coverage(
            batch.column("text"), shared.value)
        yield {"lang": lang, "share": [x[at[v]] for v, x in zip(lang, share)]}

    half = map_arrow(sample, own, "lang string, share double").groupBy("lang").agg(
        F.percentile_approx("share", 0.5).alias("share")).collect()
    half = {r["lang"]: r["share"] for r in half}
    model.level = np.array([LEVEL * half.get(v, 0.0) for v in langs])
    return model


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def _coverage(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[bool]]:
    """(share of its n-grams by language, has a letter) of every text."""
    b, off = text_buffers(texts)
    n = len(off) - 1
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    hits, seen = np.zeros((n, len(model.langs)), np.int64), np.zeros(n, np.int64)
    for d, piece in _padded(b, off):
        h = _grams(piece)
        seen[d] += len(h)
        if model.langs:
            hits[d] += model.counts(h)
    letters = []
    for d in range(n):
        raw = b[off[d] : off[d + 1]]
        letters.append(bool(ascii_letter[raw[:4096]].any()) or _has_letter(raw.tobytes()))
    return np.array([model.coverage(h, int(s)) for h, s in zip(hits, seen)]).reshape(
        n, len(model.langs)), letters


def _predict(texts: pa.Array, model: Model) -> tuple[list[str], list[float]]:
    share, letters = _coverage(texts, model)
    got = [model.decide(x) if has else ("und", 0.0) for x, has in zip(share, letters)]
    return [k for k, _ in got], [x for _, x in got]


def explained(model: Model) -> Column:
    """Whether the language that ``predict`` gave covers the text as far as its level asks."""
    level = F.lit(0.0)
    if model.langs:
        level = F.create_map(*[F.lit(x) for v, k in zip(model.langs, model.level)
                               for x in (v, float(k))])[F.col("lang_pred")]
    return (F.col("lang_pred") != "und") & (F.col("score") > 0) & (F.col("score") >= level)


def predict(docs: DataFrame, model: Model, row: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (its coverage, 0 to 1) added; whole texts.
    With ``row``, ``text`` is a field of that struct column, which is never null.

    Null, empty and letterless texts, or a model without languages: ``und`` with score 0.
    A text none of whose n-grams is known gets the first language, with score 0. Ties go to
    the language that sorts first. Only ``text`` is read; every other column is carried
    unless it is named lang_pred or score, which are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(row).field("text") if row else batch.column("text")
            lang, score = _predict(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(lean(run), schema)


def evaluate(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from the documents whose crc32 of the id
    is not 1 modulo 3, predict all."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    out = crc_mod(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~out))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score")
