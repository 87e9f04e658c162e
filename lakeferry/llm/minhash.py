"""MinHash near-dedup: universal hash minima, banding, verification, components.

1. ``sketch``: per document the size of its shingle set, a 128-bit identity of the set,
   ``BANDS`` band keys over ``BANDS * ROWS`` minima of the universal hashes a*x+b (mod
   2^64, high half kept), and one byte of every minimum as the signature. With 28 bands of
   6 rows two sets at similarity 0.8 miss each other with probability 2e-4, at 0.85 2e-6.
2. Documents with equal sets become one class, the smallest doc_id standing for it. Classes
   that share it (a repeated id with several texts) are one node, each with its own set.
3. In every band bucket each class is paired with one class of the bucket (another one in
   each band), not with all. Signatures drop pairs whose estimate is more than five
   standard deviations under the threshold; each class's best pair is confirmed on full
   sets, and the confirmed links give first components, by alternating large-star and
   small-star.
4. A bucket that still holds several components may hide links between its members. There,
   blocks of members meet blocks of members by signature, which gives clusters of alike
   components. In a cluster blocks of full sets are intersected, the classes outside the
   largest component against all. Only links that join components leave a task, as pairs
   of component labels. So no link is lost and no list of pairs of a group is written.
5. The stars again over those pairs of labels alone, which are few, give the components.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql import types as T

from .common import Scratch, bucket_of, few_tasks, map_arrow
from .components import connected_components
from .words import doc_ranges, mix, shingles, text_buffers, words

BANDS, ROWS = 28, 6
HASHES = BANDS * ROWS
BLOCK = 1024  # classes in a packed block of signatures
BLOCK_SETS = 256  # classes in one that holds full sets
BLOCK_BYTES = 4 << 20  # expected bytes of either
_CHUNK = 256
# what a task takes at least, where the whole is known to be small
ROWS_A_TASK, SKETCHES, SET_BYTES = 200_000, 20_000, 8 << 20

_rng = np.random.default_rng(20240301)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2)


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of every hash over a set of 64-bit keys, as 32-bit numbers."""
    x = s >> np.uint64(32)
    out = np.full(HASHES, 2**64 - 1, np.uint64)
    for i in range(0, len(x), _CHUNK):
        y = x[i : i + _CHUNK, None] * _A
        y += _B
        np.minimum(out, y.min(0), out=out)
    return out >> np.uint64(32)


def band_keys(m: np.ndarray) -> np.ndarray:
    h = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
    for col in m.reshape(BANDS, ROWS).T:
        h = mix(h * np.uint64(31) + col)
    return h.view(np.int64)


def _sets(batch: pa.RecordBatch, k: int):
    """(row, sorted distinct shingle hashes) of every text of a batch."""
    b, off = text_buffers(batch.column("text"))
    for i, j in doc_ranges(off):
        h, _, _, first = words(b[off[i] : off[j]], off[i : j + 1] - off[i])
        for d in range(j - i):
            yield i + d, np.unique(shingles(h[first[d] : first[d + 1]], k))


def _identity(s: np.ndarray) -> bytes:
    return np.array([s.sum(dtype=np.uint64), mix(s ^ np.uint64(len(s))).sum(
        dtype=np.uint64)]).tobytes()


def sketch(docs: DataFrame, k: int) -> DataFrame:
    def one(batch: pa.RecordBatch):
        n, sid, bands, sig = [], [], [], []
        for _, s in _sets(batch, k):
            n.append(len(s))
            if not len(s):
                sid.append(None), bands.append(None), sig.append(None)
                continue
            m = minima(s)
            sid.append(_identity(s))
            bands.append(band_keys(m))
            sig.append(m.astype(np.uint8).tobytes())
        yield {"doc_id": batch.column("doc_id"), "n_shingles": n, "sid": sid, "bands": bands,
               "sig": sig}

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), one,
                     "doc_id long, n_shingles long, sid binary, bands array<long>, sig binary")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    def one(batch: pa.RecordBatch):
        sets = [s for _, s in _sets(batch, k)]
        yield {"doc_id": batch.column("doc_id"), "sid": [_identity(s) for s in sets],
               "elems": [s.tobytes() for s in sets]}

    return map_arrow(docs.select("doc_id", "text"), one, "doc_id long, sid binary, elems binary")


def least_matches(similarity: float) -> int:
    """Equal minima that a pair at the threshold reaches but for once in about 3e6."""
    s = (similarity * (1 - similarity) * HASHES) ** 0.5
    return max(1, int(similarity * HASHES - 5 * s))


@arrow_udf(T.IntegerType())
def _matches(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, HASHES) for c in (a, b))
    return pa.array((x == y).sum(1).astype(np.int32))


# else the filters by it and by ``confirm`` are moved before the rows are dealt to few tasks
_matches = _matches.asNondeterministic()


def _linked(inter, size_a, size_b, similarity_pct: int):
    return 100 * inter >= similarity_pct * (size_a + size_b - inter)


def _confirm(similarity_pct: int):
    @arrow_udf(T.BooleanType())
    def confirm(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            i = len(np.intersect1d(x, y, assume_unique=True))
            out.append(bool(_linked(i, len(x), len(y), similarity_pct)))
        return pa.array(out, pa.bool_())

    return confirm.asNondeterministic()


def intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of all sets in ``a`` with all in ``b``: products of 0/1
    matrices over ``width`` keys at a time."""
    vocab = np.unique(np.concatenate(a))
    flat = []
    for sets in (a, b):
        row, key = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(vocab, key), len(vocab) - 1)
        hit = vocab[at] == key
        order = np.argsort(at[hit], kind="stable")
        flat.append((row[hit][order], at[hit][order]))
    out = np.zeros((len(a), len(b)), np.float64)
    for lo in range(0, len(vocab), width):
        m = []
        for (row, at), n in zip(flat, (len(a), len(b))):
            i, j = np.searchsorted(at, [lo, lo + width])
            x = np.zeros((n, width), np.float32)
            x[row[i:j], at[i:j] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def _forest(rows: np.ndarray, cols: np.ndarray, comp_a, comp_b) -> list[tuple]:
    """Of links between components, as many as join them, one for each merge: their labels."""
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    (a, ia), (b, ib) = (np.unique(c, return_inverse=True) for c in (comp_a, comp_b))
    met = np.zeros((len(a), len(b)), bool)  # however many links two components have
    met[ia[rows], ib[cols]] = True
    a, b, out = a.tolist(), b.tolist(), []
    for i, j in np.argwhere(met).tolist():
        x, y = find(a[i]), find(b[j])
        if x != y:
            up[x] = y
            out.append((a[i], b[j]))
    return out


def _block_links(rows: DataFrame, key: str, cols: list[str], least: int,
                 similarity_pct: int | None, scratch: Scratch) -> DataFrame:
    """Pairs of component labels with a link between the light blocks of a key and all its
    blocks. A block is an array of about BLOCK rows, with full sets of BLOCK_SETS rows or
    BLOCK_BYTES, of one key;
    the number of blocks of a key follows its size, so a hot key or one of very long texts
    gives more blocks, not larger ones."""
    most, size = BLOCK, F.lit(HASHES + 8 * BANDS)
    if "elems" in cols:
        most, size = BLOCK_SETS, size + F.octet_length("elems")
    part = {"light": F.col("light"), "main": ~F.col("light")}
    n = rows.groupBy(key).agg(*(F.sum(F.when(x, size).otherwise(0)).alias(f"b_{name}")
                                for name, x in part.items()),
                              *(F.count_if(x).alias(f"c_{name}") for name, x in part.items()))
    n = n.select(key, "b_light", "b_main", *(
        F.greatest(F.ceil(F.col(f"c_{name}") / most),
                   F.ceil(F.col(f"b_{name}") / BLOCK_BYTES)).alias(f"n_{name}") for name in part))
    met = Observation()
    meet = F.expr("n_light * (b_light + b_main) + b_light * (n_light + n_main)")
    n = scratch.table(few_tasks(n.observe(met, F.sum(meet).alias("bytes")), 0, 1).select(
        key, "n_light", "n_main"), "blocks")
    dealt = rows.join(n, key).withColumn("block", bucket_of(
        "cls", F.when(F.col("light"), F.col("n_light")).otherwise(F.col("n_main"))))
    x = dealt.groupBy(key, "light", "block").agg(F.collect_list(F.struct(*cols)).alias("rows"))
    left = x.where("light").select(key, F.col("block").alias("i"), F.col("rows").alias("ra"))
    right = x.select(key, F.col("light").alias("lb"), F.col("block").alias("j"),
                     F.col("rows").alias("rb"))
    pairs = few_tasks(left.join(right, key).where("not lb or j >= i").select("ra", "rb"),
                      met.get.get("bytes") or 0, SET_BYTES)

    def unpack(v):
        v = v.values
        cls, comp = (v.field(c).to_numpy() for c in ("cls", "comp"))
        sig = np.frombuffer(b"".join(v.field("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = v.field("bands").flatten().to_numpy().reshape(-1, BANDS)
        sets = [np.frombuffer(e, np.uint64) for e in v.field("elems").to_pylist()] \
            if "elems" in cols else None
        return cls, comp, sig, bands, sets

    def one(batch: pa.RecordBatch):
        found = []
        for n in range(batch.num_rows):
            ca, pa_, sa, ba, ea = unpack(batch.column("ra")[n])
            cb, pb, sb, bb, eb = unpack(batch.column("rb")[n])
            by_hash = np.ascontiguousarray(sb.T)
            alike = np.array([(by_hash == s[:, None]).view(np.uint8).sum(0, dtype=np.uint8)
                              >= least for s in sa])  # HASHES matches fit a byte
            alike &= pa_[:, None] != pb[None, :]
            if alike.any():
                i, j = np.nonzero(alike)
                if key != "band":  # else they share it
                    shared = np.zeros(len(i), bool)
                    for q in range(BANDS):
                        shared |= ba[i, q] == bb[j, q]
                    i, j = i[shared], j[shared]
                if similarity_pct is not None and len(i):
                    ui, uj = np.unique(i), np.unique(j)
                    inter = np.zeros((len(ca), len(cb)), np.int64)
                    inter[np.ix_(ui, uj)] = intersections([ea[q] for q in ui], [eb[q] for q in uj])
                    na, nb = (np.array([len(s) for s in e]) for e in (ea, eb))
                    ok = _linked(inter[i, j], na[i], nb[j], similarity_pct)
                    i, j = i[ok], j[ok]
                found += _forest(i, j, pa_, pb)
        if found:
            yield {"a": [f[0] for f in found], "b": [f[1] for f in found]}

    return map_arrow(pairs, one, "a long, b long")


def _other(c: Column) -> Column:
    return F.struct(F.xxhash64("band", c).alias("o"), c.alias("cls"))


def near_duplicates(docs: DataFrame, k: int = 5, similarity_pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_class) for every row of ``docs``.

    Words are lower-cased (A-Z only); sets are the distinct k-word shingles of whole texts,
    of shorter texts the whole sequence as one. ``component_id`` is the smallest doc_id
    reachable by links at ``similarity_pct`` percent or more; ``kept`` marks it.

    Null or wordless text: an empty set, linked with nothing, kept. Repeated rows (equal
    doc_id): equal sets link them as any others; each row is returned, so a repeated id
    that is kept is kept as often as it occurs. A doc_id that occurs with different texts
    links their components. Null doc_id: returned with a null component and kept. Other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    size = Observation()
    t = scratch.table(sketch(docs, k).observe(
        size, F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles")), "sketch")
    n_docs = size.get.get("rows") or 0
    set_bytes = 8 * (size.get.get("shingles") or 0)
    live = t.where("n_shingles > 0 and doc_id is not null")
    reps = scratch.table(few_tasks(live.groupBy("sid").agg(
        F.min("doc_id").alias("cls"), F.first("bands").alias("bands"), F.first("sig").alias("sig"),
        F.count("*").alias("n_class")), n_docs, SKETCHES), "classes")

    member = reps.select("cls", F.explode("bands").alias("band")).repartition("band")
    buckets = member.groupBy("band").agg(
        F.min(_other(F.col("cls"))).getField("cls").alias("rep"), F.count("*").alias("n"))
    met = Observation()
    seen = scratch.table(few_tasks(member.join(buckets.where("n > 1"), "band").observe(
        met, F.count("*").alias("n")), BANDS * n_docs, ROWS_A_TASK), "buckets")
    n_seen = met.get.get("n") or 0
    least = least_matches(similarity_pct / 100)
    pairs = seen.where("cls <> rep").select(
        F.least("cls", "rep").alias("a"), F.greatest("cls", "rep").alias("b")).distinct()
    sig = reps.select("cls", "sig")
    pairs = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
    pairs = few_tasks(pairs, n_seen, SKETCHES).select(
        "a", "b", _matches("sa", "sb").alias("m")).where(F.col("m") >= least)
    pairs = scratch.table(pairs, "pairs")

    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "m").unionByName(
        pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "m"))
    best = ends.groupBy("x").agg(F.max(F.struct("m", "y")).getField("y").alias("y")).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    # classes of buckets with three members or more can have links that no pair shows
    deep = seen.where("n > 2")
    need = pairs.select(F.col("a").alias("cls")).unionByName(
        pairs.select(F.col("b").alias("cls"))).unionByName(deep.select("cls")).distinct()
    ids = need.select(F.col("cls").alias("doc_id"))
    wanted = few_tasks(docs.join(ids, "doc_id", "left_semi"), set_bytes, SET_BYTES)
    sets = full_sets(wanted, k).dropDuplicates(["doc_id", "sid"])
    sets = scratch.table(few_tasks(sets, set_bytes, SET_BYTES).withColumnRenamed(
        "doc_id", "cls"), "sets")
    elems = sets.select("cls", "elems")
    both = best.join(elems.toDF("a", "ea"), "a").join(elems.toDF("b", "eb"), "b")
    links = scratch.table(few_tasks(both, 2 * set_bytes, SET_BYTES).where(
        _confirm(similarity_pct)("ea", "eb")).select("a", "b"), "links")
    comp = connected_components(links, scratch)

    def labelled(df: DataFrame, cls: str, out: str) -> DataFrame:
        return df.join(comp.toDF("_node", out), F.col(cls) == F.col("_node"), "left").withColumn(
            out, F.coalesce(out, cls)).drop("_node")

    def joined(df: DataFrame) -> DataFrame:
        """Edges between the labels of two columns of classes, a and b."""
        return labelled(labelled(df, "a", "x"), "b", "y").where("x <> y").select(
            F.col("x").alias("a"), F.col("y").alias("b"))

    sigs = reps.select("cls", "sid", "sig", "bands")
    deep = scratch.table(few_tasks(labelled(deep.select("band", "cls"), "cls", "comp"),
                                   n_seen, ROWS_A_TASK), "deep")
    sizes = deep.groupBy("band", "comp").agg(F.count("*").alias("c")).groupBy("band").agg(
        F.max(F.struct("c", "comp")).getField("comp").alias("main"), F.count("*").alias("parts"))
    rows = deep.join(sizes.where("parts > 1"), "band").withColumn(
        "light", F.col("comp") != F.col("main")).drop("main", "parts").join(sigs, "cls")
    rows = scratch.table(few_tasks(rows, n_seen, SKETCHES), "mixed")
    apart = few_tasks(joined(pairs.select("a", "b")), n_seen, ROWS_A_TASK)
    if not rows.isEmpty():
        apart = apart.unionByName(_block_links(
            rows, "band", ["cls", "comp", "sig", "bands"], least, None, scratch))
    # clusters of alike components: two of them at least in each
    cluster = connected_components(apart, scratch)
    more = []
    if not cluster.isEmpty():
        members = cluster.toDF("comp", "cluster").join(
            comp.toDF("cls", "component"), F.col("comp") == F.col("component"), "left").select(
            "cluster", "comp", F.coalesce("cls", "comp").alias("cls"))
        members = scratch.table(few_tasks(members, n_docs, ROWS_A_TASK), "clustered")
        main = members.groupBy("cluster", "comp").agg(F.count("*").alias("c")).groupBy(
            "cluster").agg(F.max(F.struct("c", "comp")).getField("comp").alias("main"))
        whole = members.join(main, "cluster").withColumn(
            "light", F.col("comp") != F.col("main")).drop("main")
        whole = whole.join(sigs, "cls").join(sets, ["cls", "sid"])
        whole = scratch.table(few_tasks(whole, set_bytes, SET_BYTES), "whole")
        more.append(_block_links(whole, "cluster", ["cls", "comp", "sig", "bands", "elems"],
                                 least, similarity_pct, scratch))
    known = live.join(reps.select("sid", "cls", "n_class"), "sid", "left").select(
        "doc_id", "n_shingles", "cls", "n_class")
    same_id = live.groupBy("doc_id").agg(F.min("sid").alias("lo"), F.max("sid").alias(
        "hi")).where("lo <> hi").select("doc_id")
    same_id = scratch.table(few_tasks(same_id, n_docs, ROWS_A_TASK), "repeated")
    if not same_id.isEmpty():  # the classes of an id are one component
        of_id = known.join(same_id, "doc_id", "left_semi").select("doc_id", "cls").distinct()
        first = of_id.groupBy("doc_id").agg(F.min("cls").alias("a"))
        more.append(joined(of_id.join(first, "doc_id").select("a", F.col("cls").alias("b"))))
    whole = labelled(known, "cls", "component")
    if more:
        last = connected_components(reduce(DataFrame.unionByName, more), scratch)
        whole = whole.join(last.toDF("_label", "last"), F.col("component") == F.col("_label"),
                           "left").withColumn("component", F.coalesce("last", "component"))
    whole = whole.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_class")
    scratch.drop(seen, pairs, links, sets, deep, rows, cluster, same_id)
    none = t.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(1).cast("long").alias("n_class"))
    return whole.unionByName(none).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "n_class")


def dedup(docs: DataFrame, k: int = 5, similarity_pct: int = 80) -> DataFrame:
    """Rows of ``docs`` with the smallest doc_id of every component; columns unchanged.
    Rows of one kept id with equal texts become one; with different texts each text stays.
    Rows with a null id or no words all stay. An empty table gives an empty result."""
    gone = near_duplicates(docs, k, similarity_pct).where("not kept").select(
        F.col("doc_id").alias("gone_id")).distinct()
    rest = docs.join(gone, docs.doc_id == gone.gone_id, "left_anti")
    again = rest.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("again_id"))
    if again.isEmpty():
        return rest
    once = rest.join(again, rest.doc_id == again.again_id, "left_anti")
    return once.unionByName(rest.join(again, rest.doc_id == again.again_id, "left_semi")
                            .dropDuplicates(["doc_id", "text"]))
