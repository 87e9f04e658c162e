"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays in one shard, unless it outweighs a whole
shard: only then is it cut, by a hash of the id into the 256 or more salts that its rows
have, each a unit of a small part of a shard that differencing places by its bytes. Differencing starts with one
partial partition per group and repeatedly combines the two with the largest spread, the
heaviest part of one with the lightest of the other. It runs in tasks over buckets of
about ``UNITS`` groups; what the buckets give are partial partitions again, combined by the
same rule in levels of ``FAN`` until one is left. Nothing in a task grows with the input.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bucket_of

UNITS = 50_000  # expected groups in a task
FAN = 256  # partial partitions combined in a task
SALT_ROWS = 50_000  # expected rows at most that one group has in a task
ROW_BYTES = 16


def difference(sums: np.ndarray) -> np.ndarray:
    """Labels of the parts of m partial partitions (rows of ``sums``, k parts each) in one
    partition: those with the largest spread are combined first, oppositely ordered."""
    m, k = sums.shape
    sums = sums.astype(np.int64)
    vec = dict(enumerate(sums))
    heap = list(zip((sums.min(1) - sums.max(1)).tolist(), range(m)))
    heapq.heapify(heap)
    steps = []
    for new in range(m, 2 * m - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        va, vb = vec.pop(a), vec.pop(b)
        sa, sb = np.argsort(-va, kind="stable"), np.argsort(vb, kind="stable")
        v = va[sa] + vb[sb]
        steps.append((new, a, b, sa, sb))
        vec[new] = v
        heapq.heappush(heap, (int(v.min() - v.max()), new))
    labels = {(2 * m - 2): np.arange(k)}
    for new, a, b, sa, sb in reversed(steps):
        at = labels.pop(new)
        for old, order in ((a, sa), (b, sb)):
            x = np.empty(k, np.int64)
            x[order] = at
            labels[old] = x
    return np.array([labels[i] for i in range(m)])


def _place_units(k: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_k=pdf["grp"].map(bytes)).sort_values(
            ["n_bytes", "_k", "chunk"], ascending=[False, True, True], ignore_index=True)
        sums = np.zeros((len(pdf), k), np.int64)
        sums[:, 0] = pdf["n_bytes"]
        pdf["part"] = difference(sums)[:, 0]
        pdf["before"] = pdf.groupby("part")["n_rows"].cumsum() - pdf["n_rows"]
        return pdf[["bucket", "grp", "chunk", "part", "n_rows", "n_bytes", "before"]]

    return fn


def _combine(k: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf.pivot_table(index="node", columns="part", values="n_bytes", aggfunc="sum")
        t = t.reindex(columns=range(k)).fillna(0).sort_index()
        to = difference(t.to_numpy(np.int64))
        nodes = np.repeat(t.index.to_numpy(), k)
        return pd.DataFrame({"node": nodes, "part": np.tile(np.arange(k), len(t)),
                             "up": int(pdf["up"].iloc[0]), "to": to.ravel()})

    return fn


def shard(docs: DataFrame, n_shards: int = 40, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (of its columns ``keep`` only, so that a text that is not kept is not
    shuffled) with ``shard`` (0 to n_shards-1) and ``slot`` (gapless from 0 in
    each shard) added. A row weighs the UTF-8 bytes of its text plus 16.

    Null texts weigh 16 and form no group but with rows of the same doc_id; empty texts are
    equal texts. Repeated rows are kept and placed one by one. A null doc_id counts as any
    other. Columns named shard or slot are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.drop("shard", "slot")
    text, key = F.col("text").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("doc"), F.col("doc_id").alias("order_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), text), F.concat(F.lit("n"), key)))).alias("grp"),
        F.xxhash64(F.lit(13), key).alias("deal"))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    salts = max(256, math.ceil(n / SALT_ROWS))
    rows = rows.withColumn("salt", F.pmod("deal", F.lit(salts))).drop("deal")
    part = scratch.table(rows.groupBy("grp", "salt").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes")), "parts")
    heavy = part.groupBy("grp").agg(F.sum("n_bytes").alias("b")).where(
        F.col("b") * n_shards > total).select(  # fewer than n_shards groups can be
        "grp", F.lit(True).alias("heavy"))
    part = part.join(F.broadcast(heavy), "grp", "left").withColumn(
        "chunk", F.when(F.col("heavy"), F.col("salt")).otherwise(F.lit(0)).cast("long")).drop("heavy")
    part = scratch.table(part, "units")
    units = part.groupBy("grp", "chunk").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
    n_units = units.count()
    buckets = max(1, math.ceil(n_units / UNITS))
    placed = scratch.table(
        units.withColumn("bucket", F.pmod(F.xxhash64("grp", "chunk"), F.lit(buckets)))
        .groupBy("bucket").applyInPandas(
            _place_units(n_shards), "bucket long, grp binary, chunk long, part long, n_rows long, "
            "n_bytes long, before long"), "placed")

    sums = placed.groupBy("bucket", "part").agg(
        F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows"))
    where = sums.select("bucket", "part", "n_bytes", "n_rows", F.col("bucket").alias("node"),
                        F.col("part").alias("at"))
    width = buckets
    while True:  # one level joins FAN nodes; a single node is only renamed
        level = where.groupBy("node", "at").agg(F.sum("n_bytes").alias("n_bytes")).select(
            "node", F.col("at").alias("part"), "n_bytes", F.floor(F.col("node") / FAN).alias("up"))
        moved = level.groupBy("up").applyInPandas(
            _combine(n_shards), "node long, part long, up long, to long")
        where = scratch.table(
            where.join(moved.withColumnRenamed("part", "at"), ["node", "at"])
            .select("bucket", "part", "n_bytes", "n_rows", F.col("up").alias("node"),
                    F.col("to").alias("at")), "where")
        width = math.ceil(width / FAN)
        if width <= 1:
            break
    base = Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    where = where.select("bucket", "part", F.col("at").alias("shard"),
                         F.coalesce(F.sum("n_rows").over(base), F.lit(0)).alias("base"))
    spot = placed.join(where, ["bucket", "part"]).select(
        "grp", "chunk", "shard", (F.col("base") + F.col("before")).alias("start"))
    in_unit = Window.partitionBy("grp", "chunk").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    spot = part.join(spot, ["grp", "chunk"]).select(
        "grp", "salt", "shard", (F.col("start") + F.coalesce(
            F.sum("n_rows").over(in_unit), F.lit(0))).alias("start"))
    spot = scratch.table(spot, "spots")
    scratch.drop(placed, part)
    turn = F.row_number().over(Window.partitionBy("grp", "salt").orderBy("order_id"))
    return rows.join(spot, ["grp", "salt"]).select(
        "doc.*", F.col("shard").cast("int").alias("shard"),
        (F.col("start") + turn - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> None:
    """Parquet files of the shards, each shard in its own folder and in the order of slots."""
    placed = shard(docs, n_shards)
    placed.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions(
        "shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of the placed rows."""
    text = F.col("text").cast("string")
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    return shard(facts, n_shards, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
