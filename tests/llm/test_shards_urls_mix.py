"""Sharding, URL filters and mixing on fixtures."""

import inspect
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from lakeferry.llm import mixing, sharding, urls
from lakeferry.llm.common import Scratch


def test_differencing_is_tighter_than_greedy():
    r = np.random.default_rng(1)
    size = r.integers(1, 10_000, 200)
    sums = np.zeros((200, 5), np.int64)
    sums[:, 0] = size
    got = np.bincount(sharding.difference(sums)[:, 0], weights=size, minlength=5)
    greedy = np.zeros(5)
    for s in sorted(size, reverse=True):
        greedy[greedy.argmin()] += s
    assert np.ptp(got) <= np.ptp(greedy) and got.sum() == size.sum()
    assert sharding.difference(np.array([[3, 1]])).tolist() == [[0, 1]]


def test_shards(wide, rows, none, monkeypatch):
    monkeypatch.setattr(sharding, "UNITS", 10)  # several buckets and two levels
    monkeypatch.setattr(sharding, "FAN", 3)
    got = [(x.doc_id, x.text, x.shard, x.slot) for x in sharding.shard(wide, 4).collect()]
    assert sorted(((d, t) for d, t, *_ in got), key=str) == sorted(((r[0], r[1]) for r in rows), key=str)
    slots, where = defaultdict(list), defaultdict(set)
    for _, text, shard, slot in got:
        slots[shard].append(slot)
        if text is not None:
            where[text].add(shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    assert sharding.shard(none, 4).count() == 0


def test_only_a_group_heavier_than_a_shard_is_cut(spark):
    rows = [(i, "copy " * 20) for i in range(3000)] + [(5000 + i, f"text {i} " * 9) for i in range(900)]
    out = sharding.digest(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert size.max() - size.min() <= 0.01 * size.mean()
    small = out[out["doc_id"] >= 5000]
    assert len(out) == len(rows) and len(small["shard"].unique()) > 1


def test_forty_shards_with_a_third_of_all_bytes_in_one_text(spark):
    import zlib

    r = np.random.default_rng(4)
    rows = [(i, "hot text " * 30) for i in range(2600)]
    rows += [(10_000 + i, "é" * int(r.integers(0, 250)) + f"{i}") for i in range(4500)]
    rows += [(30_000 + i, "pair") for i in range(50)] + [(40_000, None), (None, "x"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.digest(df, 40)
    assert out.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                   for i, t in rows), key=str)
    assert sorted(((g.doc_id, g.size, g.text_crc32) for g in got), key=str) == want
    slots, load, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for g in got:
        slots[g.shard].append(g.slot)
        load[g.shard] += g.size
        homes[g.text_crc32].add(g.shard)
    assert set(load) == set(range(40)) and all(
        sorted(s) == list(range(len(s))) for s in slots.values())
    hot = zlib.crc32(("hot text " * 30).encode())
    assert all(len(h) == 1 for c, h in homes.items() if c != hot) and len(homes[hot]) > 13
    assert max(load.values()) - min(load.values()) <= 2 * (len("hot text " * 30) + 16)


HTML = '<html><head><link rel="canonical" href="{}"></head></html>'
PAGES = [
    (1, "http://a.org/x", HTML.format("https://b.org/y")),
    (2, "http://b.org/y#frag", '<META HTTP-EQUIV=refresh content="0; url=http://sub.site.net/es/z">'),
    (3, "http://c.org/p/q", HTML.format("r")),  # relative
    (4, "http://c.org/p/r", HTML.format("/s?k=1&amp;m=2")),
    (5, "http://c.org/s?k=1&m=2", HTML.format("//d.net/fr/")),
    (6, "http://e.org/1", HTML.format("http://x.net/fr/1")),
    (7, "http://e.org/2", HTML.format("http://e.org/1")),
    (8, "http://e.org/2", HTML.format("http://WWW.example.com/en/ok")),  # allowed member
    (9, "http://News.Example.com/en/1", None), (10, "http://www.example.com/en/1", ""),
    (11, "http://other.com", "<p>"), (12, None, HTML.format("http://x.net/fr/1")),
    (13, "no scheme", HTML.format("http://x.net/fr/1")), (None, "http://q.net/es/", None),
    (14, "http://lone.org/", HTML.format("http://lone.org/")), (15, "http://", "x"),
    (16, "ftp://host.net?es=/es/", ""),
    (17, "http://f.org/a/b/c", HTML.format("../../t/./u")), (18, "http://f.org/t/u", None),
    (19, "http://f.org/a/../t/u", HTML.format("http://g.net/x/../fr/")),
    (20, "http://h.org/1", HTML.replace("canonical", "alternate Canonical").format("/../h.net/..")),
    (21, "http://h.org/", HTML.replace('"canonical"', "canonical").format("http://x.net/fr/./9")),
    (22, "http://i.org/1", HTML.replace("canonical", "not-canonical").format("http://x.net/fr/8")),
    (23, "http://i.org/2", HTML.replace("rel=", "data-rel=").format("http://x.net/fr/8")),
    (24, "http://j.net/a/../fr/1", None),  # its own rule sees the path as it stands
]


def test_urls_equal_sql_and_pass_blocks_to_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(pages.selectExpr("*", "1 AS host", "2 AS node")).collect()}
    verdict = {i: got[i].verdict for i in got}
    blocked = {1, 2, 3, 4, 5, 9, 17, 18, 19, 20, 21, None}
    assert {i for i, v in verdict.items() if v == "block"} == blocked
    assert got[9].rule == "example.com/en/" and got[10].rule == "www.example.com/en/"
    assert got[12].host == "" and got[12].path == "" and got[16].path == "" and got[11].rule is None
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    want = con.execute(urls.ORACLE).fetchall()
    assert sorted(want, key=str) == sorted(map(tuple, got.values()), key=str)
    assert urls.judge(pages.where("false")).count() == 0
    assert "Arrow" not in inspect.getsource(urls) and "native=True" in inspect.getsource(urls)


def test_redirect_log_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.org/1", ""), (2, "http://b.org/2", "")],
                                  "page_id long, url string, html string")
    log = spark.createDataFrame([("http://b.org/2", "http://x.net/es/"), (None, "http://a.org/1")],
                                "src string, dst string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, edges=log).collect()}
    assert got == {1: "allow", 2: "block"}


def test_raking_reaches_all_marginals(spark):
    cells = spark.createDataFrame(
        [("a", "x", "p", 100), ("a", "y", "q", 50), ("b", "x", "q", 400), ("b", "y", "p", 10),
         ("c", "x", "p", 7), ("c", "z", "q", 30), ("c", "z", "p", 0)],
        "source string, lang string, topic string, n_tokens long")
    goal = {"source": {"a": 0.5, "b": 0.3}, "lang": 0.5, "topic": {"p": 0.6, "q": 0.4}}
    got = mixing.rake(cells, goal, Scratch(spark)).toPandas()
    got["w"] = got["weight"] * got["n_tokens"] / 597
    share = got.groupby("source")["w"].sum()
    assert share.to_dict() == pytest.approx({"a": 0.5, "b": 0.3, "c": 0.2}, abs=1e-9)
    assert got.groupby("topic")["w"].sum().to_dict() == pytest.approx({"p": 0.6, "q": 0.4}, abs=1e-9)


def test_mix_keeps_rows_whole(wide, docs, none, rows):
    out = mixing.weigh(wide).select("doc.doc_id", "n_tokens", "weight", "prob", "kept").collect()
    assert len(out) == len(rows) and all(0 <= r.prob <= 1 for r in out)
    assert max(r.prob for r in out) == 1.0
    got = mixing.mix(wide)
    assert got.columns == wide.columns and 0 < got.count() < len(rows)
    assert mixing.mix(none).count() == 0 and mixing.mix(docs.where("text = ''")).count() == 0


def test_unnamed_values_share_what_the_named_leave(spark, caplog, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "a b c d", "en", "s", "x"), (2, "a b", "de", "s", "x"), (3, "a b", None, "s", "y"),
         (4, "a b c d e f", "xx", "s", None)],
        "doc_id long, text string, lang string, source string, about string")
    goal = {"lang": {"en": 0.6, "de": 0.2}}
    got = {r.lang: (r.topic, r.weight * r.n_tokens / 14)
           for r in mixing.weigh(docs, goal, topic="about").collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "en": "x", "de": "x", mixing.NO_VALUE: "y", "xx": mixing.NO_VALUE}
    share = {k: v[1] for k, v in got.items()}
    assert share == pytest.approx({"en": 0.6, "de": 0.2, mixing.NO_VALUE: 0.05, "xx": 0.15}, abs=1e-5)
    assert not caplog.records
    monkeypatch.setattr(mixing, "MAX_SWEEPS", 2)
    mixing.weigh(docs, {"lang": {"en": 0.9, "de": 0.0}, "topic": {"y": 0.5}}, topic="about")
    assert any("not reached" in r.message for r in caplog.records)
