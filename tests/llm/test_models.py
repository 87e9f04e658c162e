"""Nearest vectors, the language model and packing against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from lakeferry.llm import ann, katz, packing


def test_nearest_vectors_recall_ties_and_edges(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    r = np.random.default_rng(2)
    x = r.standard_normal((3000, 48))
    x[1000:2000] = x[0] + 0.01 * r.standard_normal((1000, 48))  # a crowd
    x[2000:2200] = x[5]  # equal vectors: ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 48), (5003, [float("nan")] * 48),
           (5004, [1.0, None] * 24), (5005, [1.0] * 47), (5100, [float("inf")] * 48),
           (None, x[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "1 AS score", "2 AS block", "3 AS v")
    got = defaultdict(list)
    for q in ann.search(df, df.where("vec_id % 100 = 0")).collect():
        got[q.query_id].append((q.rank, q.vec_id, q.score))
    assert set(got) == set(range(0, 3000, 100))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert np.allclose([f[2] for f in found], d[[f[1] for f in found]], rtol=0, atol=1e-12)
        hit += len(set(best) & {f[1] for f in found})
        if 2000 <= q < 2200:
            assert [f[1] for f in found] == [5, *[i for i in range(2000, 2011) if i != q][:9]]
    assert hit / (10 * len(got)) >= 0.98
    assert ann.search(df.where("false"), df).count() == 0
    few = df.where("vec_id in (0, 7, 9)")
    assert [q.rank for q in ann.search(few, few.where("vec_id = 0")).collect()] == [1, 2]


def brute_nearest(x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    return np.lexsort((np.arange(len(x)), d))[:k]


def test_bounds_hold_for_nearly_all_rows():
    r = np.random.default_rng(5)
    for dim in (1, 3, 64, 100):
        x, q = r.standard_normal((400, dim)), r.standard_normal((50, dim))
        centre, turn = x.mean(0), ann.rotation(dim)
        est, slack = ann.bounds(*ann.encode(x, centre, turn), q, centre, turn)
        true = ((x[:, None] - q) ** 2).sum(2)
        assert (est - slack <= true).mean() >= 0.98
        assert dim < 64 or abs((est - true).mean()) < 0.05 * true.mean()


def test_cells_find_the_nearest_and_visit_few_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 100)
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "QUERIES", 7)
    r = np.random.default_rng(3)
    x = np.repeat(4 * r.standard_normal((20, 32)), 200, 0) + r.standard_normal((4000, 32))
    x[100:1500] = x[0]  # a third of all rows is one vector
    cells = ann.fit_cells(x, len(x), 10)
    assert len(cells.centres) > 20 and cells.probes <= len(cells.centres) // 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>").repartition(5)
    got = defaultdict(list)
    for q in ann.search(df, df.where("vec_id % 100 = 0")).collect():
        got[q.query_id].append((q.rank, q.vec_id))
    assert set(got) == set(range(0, 4000, 100))
    hit = 0
    for q, found in got.items():
        assert [f[0] for f in sorted(found)] == list(range(1, 11))
        hit += len(set(brute_nearest(x, q)) & {f[1] for f in found})
    assert hit / (10 * len(got)) >= 0.95


def test_queries_of_small_cells_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 30)
    r = np.random.default_rng(4)
    # 200 rows in 4 crowds of 48, and a far one of 8 that has fewer than k rows
    x = np.repeat(100 * r.standard_normal((4, 8)), 48, 0) + r.standard_normal((192, 8))
    x = np.vstack([x, 1000 + r.standard_normal((8, 8))])
    monkeypatch.setattr(ann, "fit_cells", lambda sample, n, k: ann.Cells(
        np.vstack([x[24:192:48], x[196]]), 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.where("vec_id in (100, 199)").unionByName(df.where("vec_id = 100"))
    asked = asked.unionByName(df.where("vec_id = 3").selectExpr(
        "100L AS vec_id", "transform(embedding, c -> 1e6D) AS embedding"))
    asked = asked.unionByName(df.where("vec_id = 5").selectExpr(
        "100L AS vec_id", "cast(null as array<double>) AS embedding"))
    got = defaultdict(list)
    for q in ann.search(df, asked).collect():
        got[q.query_id].append((q.rank, q.vec_id))
    for q in (100, 199):  # of the vectors asked as 100 the smallest is its own
        assert [v for _, v in sorted(got[q])] == brute_nearest(x, q).tolist()
    assert len(got) == 2


def katz_brute(rows):
    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for i, (d, *_) in enumerate(rows)}
    tok = [(t or "").encode().lower().split() + [None] for _, t, *_ in rows]
    c1, nxt = Counter(), defaultdict(Counter)
    for i, t in enumerate(tok):
        if not held[i]:
            c1.update(t)
            for h, w in zip(["<s>", *t], t):
                nxt[h][w] += 1
    n_r = lambda cs: [sum(c == r for c in cs) for r in range(1, 7)]
    n = sum(c1.values())
    d1 = katz.good_turing(n_r(c1.values()))
    d2 = katz.good_turing(n_r([c for s in nxt.values() for c in s.values()]))
    cut = lambda d, c: d[c] * c if c < 6 else c
    free = n - sum(cut(d1, c) for c in c1.values())
    norm = n if free > 0 else n + 1
    unknown = 1 - sum(cut(d1, c) for c in c1.values()) / norm
    p1 = lambda w: cut(d1, c1[w]) / norm if w in c1 else unknown
    size, back = {}, {}
    for h, s in nxt.items():
        size[h] = sum(s.values())
        left = size[h] - sum(cut(d2, c) for c in s.values())
        if left <= 1e-9:
            size[h], left = size[h] + 1, 1
        back[h] = left / size[h] / (1 - sum(map(p1, s)))
    out = []
    for i, t in enumerate(tok):
        total = base = 0.0
        for h, w in zip(["<s>", *t], t):
            c = nxt[h][w] if h in nxt else 0
            total += math.log10(cut(d2, c) / size[h] if c else back.get(h, 1.0) * p1(w))
            base += math.log10((c1.get(w, 0) + 0.5) / (n + 0.5 * (len(c1) + 1)))
        out.append((rows[i][0], held[i], len(t), sum(w in c1 for w in t), n, base, total))
    whole = max(abs(sum(cut(d2, c) for c in nxt[h].values()) / size[h]
                    + back[h] * (1 - sum(map(p1, nxt[h]))) - 1) for h in nxt)
    return out, whole


def test_katz_equals_brute_force(wide, rows, none, monkeypatch):
    monkeypatch.setattr(katz, "PARTITION", 5000)  # many table partitions
    monkeypatch.setattr(katz, "BLOCK", 20_000)
    want, off = katz_brute(rows)
    assert off < 1e-9  # exactly normalised
    key = lambda r: (str(r[0]), r[2])
    got = sorted(map(tuple, katz.score(wide).collect()), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)
    assert katz.score(none).count() == 0


def test_katz_with_nothing_to_learn_from(spark):
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = katz.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert got.train_tokens == 0 and got.n_known == 0 and got.score == 0.0


def test_good_turing_stays_a_discount():
    for n_r in ([0] * 6, [10, 0, 0, 0, 0, 0], [5, 50, 3, 2, 1, 9], [100, 40, 20, 12, 8, 5]):
        d = katz.good_turing(n_r)
        assert ((d[1:] > 0) & (d[1:] < 1)).all()


def test_packing_round_trip(wide, rows, none):
    from tokenizers import Tokenizer

    got = packing.pack(wide).toPandas()
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for d, t, *_ in rows:
        want[(d, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,))] += 1
    per = defaultdict(list)
    for d, s, ids, n, q, o in zip(got["doc_id"], got["start"], got["ids"], got["doc_tokens"],
                                  got["sequence_id"], got["offset"]):
        per[(None if d != d else int(d), n)].append((s, np.frombuffer(ids, "<u2")))
    made = sum(len(x) for _, x in (p for ps in per.values() for p in ps))
    assert made == sum(len(ids) * c for (_, ids), c in want.items())
    for (d, ids), c in want.items():
        pieces = sorted(per[(d, len(ids))], key=lambda p: p[0])
        assert [int(x) for _, p in pieces[::c] for x in p] == list(ids)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= packing.SEQ
        assert s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]]
    assert packing.pack(none).count() == 0


def test_fast_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    enc = packing._encoder(packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS))
    for t in ("", " ", "a  b\n\n c\t", "it's <|endoftext|> x", "ä€😀   y", "  \r\n1२३", "<|endoftext|>"):
        assert enc.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_column_generation_covers_demand_with_few_sequences():
    r = np.random.default_rng(4)
    sizes = np.arange(1, 129)
    demand = r.integers(0, 400, 128)
    sizes, demand = sizes[demand > 0], demand[demand > 0]
    used = packing.solve(sizes, demand, 128)
    made = sum(np.array(p) * n for p, n in used)
    assert (made == demand).all() and all(np.dot(p, sizes) <= 128 for p, _ in used)
    assert sum(n for _, n in used) <= math.ceil((sizes * demand).sum() / 128) * 1.01 + 1
    assert packing.solve(np.zeros(0, np.int64), np.zeros(0, np.int64), 128) == []
