"""Near-dedup against a brute-force version over all pairs, and its edge cases."""

import random
import time

import numpy as np
import pytest

from lakeferry.llm import minhash
from lakeferry.llm.common import Scratch
from lakeferry.llm.components import connected_components
from lakeferry.llm.words import shingles, text_buffers, words
from lakeferry.session import conf_scope


def sets_of(rows, k):
    out = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        m = min(k, len(w))
        out.append((doc_id, {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if w else set()))
    return out


def brute(rows, k, pct=80):
    sets = sets_of(rows, k)
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            both = len(x & y)
            if 100 * both >= pct * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return sorted(((d, len(s), find(d)) for d, s in sets), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_equals_brute_force(wide, rows, k):
    got = [tuple(r) for r in minhash.near_duplicates(wide, k).collect()]
    assert sorted(((d, n, c) for d, n, c, *_ in got), key=str) == brute(rows, k)
    assert all(kept == (d is None or d == c) for d, _, c, kept, _ in got)


def test_group_of_near_copies_chained_below_the_threshold(spark):
    """Copies of one text, each with other changes: some pairs link, many don't; blocks of
    candidates and full sets must find every link that joins."""
    r, base = random.Random(3), [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        for q in r.sample(range(200), r.choice([2, 6, 10, 14, 18])):
            w[q] = f"z{i}x{q}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, 2).collect()}
    want = {d: c for d, _, c in brute(rows, 2)}
    assert got == want and len(set(want.values())) > 5


def test_small_tables_in_many_shuffle_partitions_take_few_tasks(spark, monkeypatch):
    """Where Spark may not join small partitions, each of dozens of small tables was written
    by as many tasks, each with its Python worker and its file, as there are partitions."""
    r, base = random.Random(5), [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        w = [f"a{i % 9}x{x}" for x in base]
        for q in r.sample(range(60), r.choice([0, 1, 3, 5])):
            w[q] = f"z{i}x{q}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    files, table = {}, Scratch.table

    def counted(self, df, name):
        out = table(self, df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(Scratch, "table", counted)
    few = 2 * spark.sparkContext.defaultParallelism
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                            "spark.sql.shuffle.partitions": str(4 * few)}):
        got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, 2).collect()}
    assert got == {d: c for d, _, c in brute(rows, 2)}
    # the first edges of the last two runs also hold links from blocks
    assert files.pop("edges") <= 3 * few and len(files) > 8
    assert max(files.values()) <= few, files


def test_many_links_of_two_components_are_one_merge():
    """Blocks of near copies have millions of links; each went through a loop of its own."""
    n = 2000
    i, j = (x.ravel() for x in np.indices((n, n)))
    comp_a, comp_b = np.repeat([5, 9], n // 2), np.repeat([2, 5], n // 2)
    began = time.process_time()
    got = minhash._forest(i, j, comp_a, comp_b)
    assert time.process_time() - began < 1
    assert len(got) == 2 and {x for link in got for x in link} == {2, 5, 9}


def test_pairs_that_share_only_crowded_buckets(spark):
    """300 documents hold the same 134 words and are no copies of each other. The pairs at
    similarity 0.81 below share one band, and its bucket holds 145 of them, so neither is
    its rep and only the blocks see the pair, as a cluster of two classes."""
    base = [f"w{i}" for i in range(134)]
    rows = [(i, " ".join(base + [f"f{i}x{q}" for q in range(66)])) for i in range(300)]
    for i in (278, 2305, 2885, 2886, 3447):
        own = [f"p{i}x{q}" for q in range(66)]
        rows += [(10 * i + 1000, " ".join(base + own)),
                 (10 * i + 1001, " ".join(base + own[:45] + [f"q{i}x{q}" for q in range(21)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, 2).collect()}
    want = {d: c for d, _, c in brute(rows, 2)}
    assert got == want and sum(d != c for d, c in want.items()) == 5


def test_repeated_id_with_two_texts_links_the_copies_of_both(spark):
    r, rows = random.Random(4), []
    for i in range(20):
        for j in range(2):
            w = [f"a{i}x{j}x{q}" for q in range(100)]
            rows.append((10 * i, " ".join(w)))
            w[r.randrange(100)] = "changed"
            rows.append((10 * i + 1 + j, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, 2).collect()}
    assert got == {d: d // 10 * 10 for d, _ in rows}


def test_empty_and_dedup(none, wide, rows):
    assert minhash.near_duplicates(none).count() == 0
    got = minhash.dedup(wide, 5)
    assert got.columns == wide.columns
    ids = [x.doc_id for x in got.select("doc_id").collect()]
    best = {d for d, _, c in brute(rows, 5) if d == c and d is not None}
    assert sorted(i for i in ids if i is not None) == sorted(best) and ids.count(None) == 1


def test_components(spark):
    scratch = Scratch(spark)
    edges = [(i, i + 1) for i in range(50)] + [(100, 7), (60, 61), (61, 61), (None, 3), (60, 61)]
    edges += [(1000, 1000 + i) for i in range(1, 300)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), scratch)
               .collect())
    assert all(got[i] == 0 for i in [*range(51), 100]) and got[60] == got[61] == 60
    assert all(got[1000 + i] == 1000 for i in range(300))
    assert connected_components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_words_cut_long_texts_between_words():
    import pyarrow as pa

    text = " ".join(f"Wörd{i % 977}" for i in range(300_000))
    b, off = text_buffers(pa.array([text, None, "a\x0bb", ""]))
    h, s, e, first = words(b[: off[1]], np.array([0, off[1]]))
    assert len(h) == 300_000 and len(np.unique(h)) == 977
    assert b[s[5]:e[5]].tobytes() == "Wörd5".encode()
    assert len(words(b[off[1]:], off[1:] - off[1])[0]) == 2
    assert len(shingles(h[:1], 2)) == 1 and len(shingles(h[:0], 2)) == 0
