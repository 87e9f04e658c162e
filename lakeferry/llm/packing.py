"""Packing token sequences as a cutting-stock problem, by column generation.

A document is cut into pieces of ``SEQ`` tokens, each a sequence of its own, and one rest.
Rests are counted by length class (``STEP`` tokens). A linear program over patterns of
classes is solved by column generation: a knapsack over the prices of the classes finds
the pattern to add, until none pays. The rounded patterns, and a first-fit remainder of
less than one sequence per pattern, give places to the documents ranked in each class. The
program sees only the histogram (``SEQ / STEP`` classes), however many documents there are.
"""

from __future__ import annotations

import base64
import functools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, lean, small_batches

SEQ, STEP, END = 2048, 16, 1
OUT_ROWS = 1000  # pieces in a batch that leaves a task
RANK_ROWS = 20_000  # expected rows that one task ranks
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as the ``tokenizers`` file gives them. The same vocabulary as ranks is read by
    ``tiktoken``, which gives the same ids for every text without a special token's string
    in a third of the time; texts with one go to ``tokenizers``."""

    def __init__(self, path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(TOKENIZER, pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint16)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint16)


@functools.cache
def _encoder(path: str, ranks_path: str) -> Encoder:
    return Encoder(path, ranks_path)  # one in each Python worker


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_tokens(docs: DataFrame, path: str, ranks_path: str, digest: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, doc_tokens, ids) of every piece of every text;
    ``row`` names a row of the input, ids are unsigned 16-bit little-endian. With
    ``digest``, ids_crc32 stands in for ids."""
    last = "ids_crc32 long" if digest else "ids binary"
    ddl = f"row long, doc_id long, piece int, start long, length long, doc_tokens long, {last}"
    schema = to_arrow_schema(T._parse_datatype_string(ddl))

    def run(batches):
        enc, n = _encoder(path, ranks_path), 0
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                x = np.append(enc.ids(text.as_py() or ""), np.uint16(END)).astype("<u2")
                for p, at in enumerate(range(0, len(x), SEQ)):
                    y = x[at : at + SEQ]
                    out.append((base + n, doc_id.as_py(), p, at, len(y), len(x),
                                ids_crc32(y) if digest else y.tobytes()))
                n += 1
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(lean(run), ddl)


def _price(value: np.ndarray, sizes: np.ndarray, cap: int) -> tuple[float, np.ndarray]:
    """Best pattern by dynamic programming: any number of each class, cap units of room."""
    best, last = np.zeros(cap + 1), np.full(cap + 1, -1)
    for w in range(1, cap + 1):
        best[w] = best[w - 1]
        fit = sizes <= w
        v = value[fit] + best[w - sizes[fit]]
        if len(v) and v.max() > best[w] + 1e-12:
            best[w], last[w] = v.max(), np.flatnonzero(fit)[v.argmax()]
    pattern, w = np.zeros(len(sizes), np.int64), cap
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            pattern[last[w]] += 1
            w -= sizes[last[w]]
    return float(best[cap]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, cap: int, rounds: int = 5000) -> list[tuple]:
    """Patterns (counts per class, times used) that cover the demand of each class."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(cap // sizes).astype(float)
    for _ in range(rounds):
        x = np.linalg.solve(basis, demand.astype(float))
        value, new = _price(np.maximum(0, np.linalg.solve(basis.T, np.ones(m))), sizes, cap)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, new.astype(float))
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = new
    x = np.linalg.solve(basis, demand.astype(float))
    left, use = demand.copy(), Counter()
    for p, times in zip(basis.T.astype(np.int64), np.floor(np.maximum(x, 0) + 1e-9).astype(int)):
        most = min((left[c] // p[c] for c in np.flatnonzero(p)), default=0)
        if min(times, most) > 0:
            use[tuple(p)] += int(min(times, most))
            left -= p * min(times, most)
    order = np.argsort(-sizes)
    while left.any():  # first fit, the largest first
        p, room = np.zeros(m, np.int64), cap
        for c in order:
            k = min(left[c], room // sizes[c])
            p[c], room = k, room - k * sizes[c]
        times = int(min(left[c] // p[c] for c in np.flatnonzero(p)))
        use[tuple(p)] += times
        left -= p * times
    return sorted(use.items(), reverse=True)


def _running(rows: DataFrame, value, name: str, group: list[str], salts: int) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, in each group: sums per salt first,
    so no task orders a whole group."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit(17), "row"), F.lit(salts)))
    part = rows.groupBy(*group, "salt").agg(F.sum(value).alias("v"))
    earlier = Window.partitionBy(*group).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*group, "salt", F.coalesce(F.sum("v").over(earlier), F.lit(0)).alias("base"))
    inner = Window.partitionBy(*group, "salt").orderBy("row").rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.join(part, [*group, "salt"]).withColumn(
        name, F.col("base") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("base", "salt")


def pack(docs: DataFrame, path: str | None = None, ranks_path: str | None = None,
         digest: bool = False) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row for each piece
    of each row of ``docs``. Sequences hold at most ``SEQ`` tokens; offsets in one are
    gapless from 0. With ``digest``, ids_crc32 stands in for ids, taken where ids are made,
    so none are written or shuffled.

    Null and empty texts are the end id alone. Repeated rows are packed each; a null doc_id
    stays null; other columns are ignored. An empty table gives an empty result. A string
    of a special token in a text is its id, as the tokenizer has it.
    """
    scratch = Scratch(docs.sparkSession)
    small_batches(docs.sparkSession)
    pieces = scratch.table(cut_tokens(
        docs, path or tokenizer_path(), ranks_path or tokenizer_path(RANKS), digest), "pieces")
    rows = pieces.where("piece = 0").select(
        "row", F.floor(F.col("doc_tokens") / SEQ).cast("long").alias("whole"),
        (F.col("doc_tokens") % SEQ).cast("int").alias("rest"))
    rows = rows.withColumn("class", F.ceil(F.col("rest") / STEP).cast("int"))
    hist = {r["class"]: r["n"] for r in rows.groupBy("class").agg(F.count("*").alias("n")).collect()}
    salts = max(64, math.ceil(sum(hist.values()) / RANK_ROWS))
    hist.pop(0, None)
    sizes = np.array(sorted(hist), np.int64)
    patterns = solve(sizes, np.array([hist[c] for c in sizes], np.int64), SEQ // STEP)

    # each pattern takes the next ranks of its classes: at most classes^2 rows
    used, seq, places = Counter(), 0, []
    for p, times in patterns:
        place = 0
        for c, k in zip(sizes.tolist(), map(int, p)):
            if k:
                places.append((c, used[c], used[c] + k * times, int(k), seq, place))
                used[c] += k * times
                place += k
        seq += times
    places = docs.sparkSession.createDataFrame(
        places, "class int, low long, high long, k int, first long, place int")

    rows = _running(rows, F.lit(1), "rank", ["class"], salts)
    rows = scratch.table(_running(rows.withColumn("all", F.lit(0)), F.col("whole"), "wholes",
                                  ["all"], salts), "rows")
    spot = rows.join(F.broadcast(places), "class").where("rank >= low and rank < high").select(
        "row", "rest", (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("k")))
        .alias("seq"), (F.col("place") + (F.col("rank") - F.col("low")) % F.col("k")).alias("spot"))
    before = Window.partitionBy("seq").orderBy("spot").rowsBetween(Window.unboundedPreceding, -1)
    spot = spot.select("row", "seq", F.coalesce(F.sum("rest").over(before), F.lit(0)).alias("at"))
    spot = rows.select("row", "wholes").join(spot, "row", "left")
    full = F.col("length") == SEQ
    return pieces.join(spot, "row").select(
        "doc_id", "start", "length", "ids_crc32" if digest else "ids", "doc_tokens",
        F.when(full, F.lit(seq) + F.col("wholes") + F.col("piece")).otherwise(F.col("seq"))
        .cast("long").alias("sequence_id"),
        F.when(full, F.lit(0)).otherwise(F.col("at")).cast("long").alias("offset"))


def evaluate(docs: DataFrame) -> DataFrame:
    return pack(docs, digest=True)
