"""Approximate nearest neighbours by randomly rotated one-bit codes.

Rows are put into cells around centres fitted on a bounded sample. A vector is taken
relative to its cell's centre, rotated by a random orthogonal matrix and kept as the signs
of its coordinates (one bit each) with two scalars: the distance to the centre and the
inner product of the unit vector with its code. A query's rotated coordinates become
``PLANES``-bit numbers, so that inner products with codes are counts of common bits of
packed words. From these the distance is estimated without bias, with an error bound; only
vectors whose lower bound could reach a query's nearest so far are compared in full.

A query first meets its own cell, which gives it k nearest so far, then, with that bound,
the next nearest cells. How many is measured on the sample: as many as hold ``PROBE_SHARE``
of the sample's own nearest neighbours. A cell is cut into blocks of about ``BLOCK`` rows,
its queries into chunks of about ``QUERIES``; of each meeting only ``k`` rows per query
leave the task.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bucket_of, map_arrow, read

BLOCK, QUERIES = 2048, 256
CELL = 1000  # rows of a cell, while the sample has CELL_SAMPLE rows for each
CELL_SAMPLE = 20
FIT_ROWS, FIT_VALUES = 40_000, 2_500_000  # bounds of the sample that centres are fitted on
FIT_ROUNDS, FIT_QUERIES = 10, 256
PROBE_SHARE = 0.995
PLANES = 4
EPSILON = 2.5  # standard deviations of the estimate in the error bound
SEED = 41


class Cells(NamedTuple):
    centres: np.ndarray
    probes: int


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T


def nearest_cells(x: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centres of each row, nearest first, ties to the first."""
    out = np.empty((len(x), n), np.int32)
    step = max(1, (1 << 22) // len(centres))
    for i in range(0, len(x), step):
        d = _squares(x[i : i + step], centres)
        out[i : i + step] = (d.argmin(1)[:, None] if n == 1 else
                             np.argsort(d, axis=1, kind="stable")[:, :n])
    return out


def fit_cells(sample: np.ndarray, n_rows: int, k: int) -> Cells:
    """Centres by k-means from distinct rows of the sample, and how many cells a query has
    to see. Neighbours lie closer in the whole table than in a sample of it, so a query
    finds rather more of them there."""
    rng = np.random.default_rng(SEED)
    distinct = np.unique(sample, axis=0)
    n = max(1, min(n_rows // CELL, len(distinct) // CELL_SAMPLE))
    centres = distinct[np.sort(rng.choice(len(distinct), n, replace=False))]
    for _ in range(FIT_ROUNDS if n > 1 else 1):
        cell = nearest_cells(sample, centres)[:, 0]
        order = np.argsort(cell, kind="stable")
        ids, first = np.unique(cell[order], return_index=True)
        centres = centres.copy()
        centres[ids] = np.add.reduceat(sample[order], first) / np.diff(
            np.append(first, len(cell)))[:, None]
    if n == 1:
        return Cells(centres, 1)
    cell = nearest_cells(sample, centres)[:, 0]
    asked = np.sort(rng.choice(len(sample), min(FIT_QUERIES, len(sample)), replace=False))
    place = np.argsort(nearest_cells(sample[asked], centres, n), axis=1)
    needed = []
    for i, q in enumerate(asked):
        d = ((sample - sample[q]) ** 2).sum(1)
        d[q] = np.inf
        needed.append(place[i, cell[np.argsort(d, kind="stable")[: min(k, len(d) - 1)]]])
    probes = math.ceil(np.quantile(np.concatenate(needed), PROBE_SHARE)) + 1
    return Cells(centres, min(n, probes))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as packed 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(
        np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """(sign bits in words, distance to the centre, inner product with the code) of rows."""
    y = (x - centre) @ turn.T
    norm = np.linalg.norm(y, axis=1)
    unit = y / np.maximum(norm, 1e-300)[:, None]
    return _words(y > 0), norm, np.abs(unit).sum(1) / math.sqrt(x.shape[1])


def bounds(bits: np.ndarray, norm: np.ndarray, corr: np.ndarray, queries: np.ndarray,
           centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances (rows x queries) and how far under them they may lie."""
    dim = queries.shape[1]
    q = (queries - centre) @ turn.T
    qn = np.linalg.norm(q, axis=1)
    unit = q / np.maximum(qn, 1e-300)[:, None]
    low = unit.min(1)
    step = np.maximum((unit.max(1) - low) / ((1 << PLANES) - 1), 1e-300)
    level = np.rint((unit - low[:, None]) / step[:, None]).astype(np.uint8)
    common = np.zeros((len(bits), len(q)), np.int32)
    for p in range(PLANES):
        plane = _words((level >> p) & 1 > 0)
        for w in range(bits.shape[1]):
            common += np.bitwise_count(bits[:, w, None] & plane[None, :, w]).astype(np.int32) << p
    ones = np.bitwise_count(bits).sum(1, dtype=np.int64)[:, None]
    dot = 2 * (common * step + ones * low) - unit.sum(1)  # of signs and the unit query
    safe = np.maximum(corr, 1e-9)[:, None]
    err = EPSILON * np.sqrt(np.maximum(0, 1 - safe**2) / max(1, dim - 1) + step**2 / 6) / safe
    both = 2 * norm[:, None] * qn
    size = norm[:, None] ** 2 + qn**2
    return size - both * dot / math.sqrt(dim) / safe, both * err + 1e-9 + 1e-12 * size


def _matrix(cell) -> tuple[np.ndarray, np.ndarray]:
    s = cell.values
    ids = s.field("vec_id").to_numpy()
    return ids, s.field("v").flatten().to_numpy().reshape(len(ids), -1)


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _at(values: np.ndarray, cell: str) -> Column:
    """The cell's entry of an array of one number a cell."""
    return F.element_at(F.lit([int(x) for x in values]), F.col(cell) + 1)


def _per_cell(df: DataFrame, n: int) -> np.ndarray:
    """Rows of every cell: at most FIT_ROWS / CELL_SAMPLE numbers."""
    counts = dict(df.groupBy("cell").count().collect())
    return np.array([counts.get(c, 0) for c in range(n)], np.int64)


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k nearest rows but those of its
    own vec_id, by Euclidean distance in double precision, ties to the smaller vec_id.

    ``rows`` and ``queries`` have vec_id and embedding. Vectors that are null, zero, or hold
    a null or non-finite component take no part, nor those with another number of
    components than most. Rows with a null vec_id take no part. Repeated rows are
    candidates each, spread over the blocks of their cell; of a query id with several
    vectors the smallest (as arrays compare) is asked. A query whose cells hold fewer than
    k candidates sees all cells; with fewer than k in the table all are given. Empty tables
    give an empty result. Other columns are ignored.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    pick = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"),
                                F.col("embedding").cast("array<double>").alias("v")).where(
                                    F.col("vec_id").isNotNull() & _usable(F.col("v")))
    rows, queries = pick(rows), pick(queries)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes["dim"], sizes["count"]
    rows, queries = (x.where(F.size("v") == dim) for x in (rows, queries))
    once = lambda df: df.groupBy("vec_id").agg(F.min("v").alias("v"))
    part = min(FIT_ROWS, FIT_VALUES // dim + 1) / n
    some = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30)) < int(min(1, part) * (1 << 30))
    drawn = once(rows.where(some)).toArrow().sort_by("vec_id").combine_chunks()
    if not drawn.num_rows:  # ids so few that none was drawn
        drawn = once(rows).orderBy("vec_id").limit(CELL_SAMPLE).toArrow().combine_chunks()
    sample = np.concatenate([_vectors(c, dim) for c in drawn.column("v").chunks])
    centres, probes = fit_cells(sample, n, k)
    turn = rotation(dim)

    def place(batch: pa.RecordBatch):
        x = _vectors(batch.column("v"), dim)
        yield {"vec_id": batch.column("vec_id"), "v": batch.column("v"),
               "cell": nearest_cells(x, centres)[:, 0]}

    placed = scratch.table(map_arrow(rows, place, "vec_id long, v array<double>, cell int"), "cells")
    blocks = np.maximum(1, -(-_per_cell(placed, len(centres)) // BLOCK))
    first = np.cumsum(blocks) - blocks

    def index(batch: pa.RecordBatch):
        out = {c: [] for c in ("block", "cell", "ids", "v", "bits", "norm", "corr")}
        for i in range(batch.num_rows):
            ids, x = _matrix(batch.column("rows")[i])
            cell = batch.column("cell")[i].as_py()
            out["block"].append(batch.column("block")[i].as_py())
            out["cell"].append(cell)
            bits, norm, corr = encode(x, centres[cell], turn)
            for c, a in (("ids", ids), ("v", x), ("bits", bits), ("norm", norm), ("corr", corr)):
                out[c].append(a.tobytes())
        yield out

    # by place, so that repeated ids spread too
    dealt = placed.withColumn("block", _at(first, "cell") + F.pmod(
        F.monotonically_increasing_id(), _at(blocks, "cell")))
    index_t = scratch.table(map_arrow(
        dealt.groupBy("block", "cell").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")),
        index, "block long, cell int, ids binary, v binary, bits binary, norm binary, "
               "corr binary"), "codes")
    scratch.drop(placed)

    def probe(batch: pa.RecordBatch):
        seen = nearest_cells(_vectors(batch.column("v"), dim), centres, probes)
        who = np.repeat(np.arange(len(seen)), probes)
        yield {"vec_id": batch.column("vec_id").take(pa.array(who)),
               "v": batch.column("v").take(pa.array(who)), "cell": seen.ravel(),
               "home": np.tile(np.arange(probes) == 0, len(seen))}

    asked_t = scratch.table(map_arrow(
        once(queries), probe, "vec_id long, v array<double>, cell int, home boolean"), "asked")
    chunks = np.maximum(1, -(-_per_cell(asked_t, len(centres)) // QUERIES))

    def meet(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            get = lambda c, t=np.float64: np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: E731,B023
            ids, x = get("ids", np.int64), get("v").reshape(-1, dim)
            bits = get("bits", np.uint64).reshape(len(ids), -1)
            q_ids, q = _matrix(batch.column("asked")[i])
            known = batch.column("asked")[i].values.field("far").to_numpy(zero_copy_only=False)
            centre = centres[batch.column("cell")[i].as_py()]
            est, slack = bounds(bits, get("norm"), get("corr"), q, centre, turn)
            out = {"query_id": [], "vec_id": [], "score": []}
            for j, qid in enumerate(q_ids):
                other, far = ids != qid, known[j] ** 2 * (1 + 1e-12)
                least = est[:, j] - slack[:, j]
                if not far < np.inf and other.sum() > k:
                    near = np.flatnonzero(other)
                    near = near[np.argpartition(est[near, j], k - 1)[:k]]
                    far = ((x[near] - q[j]) ** 2).sum(1).max() * (1 + 1e-12)
                near = np.flatnonzero(~(least > far) & other)
                d = np.sqrt(((x[near] - q[j]) ** 2).sum(1))
                best = np.lexsort((ids[near], d))[:k]
                out["query_id"].append(np.full(len(best), qid))
                out["vec_id"].append(ids[near][best])
                out["score"].append(d[best])
            yield {c: np.concatenate(v) for c, v in out.items()}

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k)

    def met(asked: DataFrame, far: Column, chunks: Column) -> DataFrame:
        """Each chunk of a cell's queries with each of the cell's blocks."""
        chunk = F.pmod(F.xxhash64(F.lit(9), "vec_id"), chunks).alias("chunk")
        packed = asked.groupBy("cell", chunk).agg(
            F.collect_list(F.struct("vec_id", "v", far.alias("far"))).alias("asked"))
        low = _at(first, "cell")
        packed = packed.select("asked", F.explode(
            F.sequence(low, low + _at(blocks, "cell") - 1)).alias("block"))
        return map_arrow(index_t.join(packed, "block"), meet,
                         "query_id long, vec_id long, score double")

    none = F.lit(float("inf"))
    own, chunk = asked_t.where("home"), _at(chunks, "cell")
    found = scratch.table(best(met(own, none, chunk)), "home")
    full = lambda: found.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("far"))
    if probes > 1:
        rest = asked_t.where("not home").join(full(), "vec_id", "left")
        found = scratch.table(best(found.drop("rank").unionByName(
            met(rest, F.coalesce("far", none), chunk))), "found")
    if probes < len(centres):
        # queries with fewer than k rows in their cells see all others too
        short = own.join(full(), "vec_id", "left_anti").drop("home")
        n_short = short.count()
        if n_short:
            seen = asked_t.select("vec_id", "cell")
            every = short.drop("cell").withColumn("cell", F.explode(F.sequence(
                F.lit(0), F.lit(len(centres) - 1)))).join(seen, ["vec_id", "cell"], "left_anti")
            found = best(found.drop("rank").unionByName(
                met(every, none, F.lit(-(-n_short // QUERIES)))))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def evaluate(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 100 = 0"), k=10)
