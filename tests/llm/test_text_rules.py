"""Quality rules, language ID and secrets on fixtures."""

import hashlib
import random
import re

import duckdb
import pytest

from lakeferry.llm import langid, quality, secrets


def test_quality_equals_sql_in_any_order(wide, rows, none):
    got = sorted(map(tuple, quality.judge(wide).collect()), key=str)
    back = sorted(map(tuple, quality.judge(wide, list(quality.RULES)[::-1]).collect()), key=str)
    assert got == back and len(got) == len(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    once = {r[0]: r[1] for r in rows if r[0] is not None}  # SQL groups by doc_id
    junk = {900: "### $$$ " * 40 + "word " * 30, 901: "same line here\n" * 30, 902: "a b\nc d\n\na b",
            903: "x y z x y z x y z q", 904: "12 34 " * 40}
    con.executemany("INSERT INTO documents VALUES (?, ?)", list((once | junk).items()))
    docs = wide.sparkSession.createDataFrame(list((once | junk).items()), "doc_id long, text string")
    a = con.execute(quality.ORACLE)
    names = [c[0] for c in a.description]
    want = sorted(a.fetchall())
    out = quality.judge(docs).select(*names)
    assert sorted(map(tuple, out.collect())) == want
    assert quality.judge(none).count() == 0


def test_rules_are_ordered_by_rejections_per_cost(docs, monkeypatch):
    import time

    slow = {"never": lambda t, i: (time.sleep(0.01), i < 0)[1],
            "always": lambda t, i: i >= 0, "costly": lambda t, i: (time.sleep(0.05), i >= 0)[1]}
    monkeypatch.setattr(quality, "RULES", slow)
    assert quality.order_rules(docs)[0] == "always"


def test_language_held_out_and_edges(wide, none, rows):
    got = {r.doc_id: r for r in langid.evaluate(wide).collect()}
    lang = {r[0]: r[2] for r in rows}
    sure = [d for d in range(60) if got[d].held_out]
    assert len(sure) > 10 and all(got[d].lang_pred == lang[d] for d in sure)
    assert got[207].lang_pred == "en" and got[205].lang_pred == "en" and got[206].lang_pred == "de"
    for d in (200, 201, 202, 204):
        assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.evaluate(none).count() == 0
    blind = langid.predict(none.sparkSession.createDataFrame([(1, "abc")], "doc_id long, text string"),
                           langid.fit(none)).collect()
    assert blind[0].lang_pred == "und"


def _spoken(lang: int, seed: int, n: int = 60) -> str:
    """Prose of an invented language: 40 words of its own syllables."""
    w = random.Random(1000 + lang)
    syl = ["".join(w.choice("bcdfghjklmnprstvz") + w.choice("aeiou") for _ in range(2))
           for _ in range(20)]
    vocab = ["".join(w.sample(syl, 2)) for _ in range(40)]
    r = random.Random(lang * 100_000 + seed)
    return " ".join(r.choice(vocab) for _ in range(n))


def test_a_language_of_two_short_texts_learns(spark):
    rows = [(k * 1000 + i, _spoken(k, i), f"big{k}") for k in range(2) for i in range(150)]
    rows += [(9001, _spoken(5, 0, 12), "a_rare"), (9002, _spoken(5, 1, 12), "a_rare")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [rows[-1][:2], rows[-2][:2], (1, _spoken(0, 999)), (2, _spoken(1, 999))]
    got = {r.doc_id: r for r in langid.predict(
        spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (9001, 9002, 1, 2)] == ["a_rare", "a_rare", "big0", "big1"]
    assert got[9001].score > 0.5


def test_more_languages_than_a_word_has_bits(spark):
    n = 70
    rows = [(100 * k + i, _spoken(k, i), f"l{k}") for k in range(n) for i in range(8)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == n and len(model.cells) == 2
    new = spark.createDataFrame([(k, _spoken(k, 99)) for k in range(n)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(new, model).collect()}
    assert sum(got[k] == f"l{k}" for k in range(n)) >= 0.97 * n


@pytest.mark.parametrize("n_langs", [2, 20])
def test_texts_of_no_learned_language_go(spark, n_langs):
    import corpus_pipeline

    rows = [(100 * k + i, _spoken(k, i), f"l{k}") for k in range(n_langs) for i in range(20)]
    clean = [(9000 + k, _spoken(k, 99), None) for k in range(n_langs)]
    r = random.Random(8)
    word = rows[0][1].split()[0]
    gone = [(10_000 + i, _spoken(500 + i, 1), None) for i in range(10)]
    gone += [(11_000 + i, "".join(chr(r.randint(97, 122)) for _ in range(300)) + f" {word}", None)
             for i in range(10)]
    docs = spark.createDataFrame(rows + clean + gone, "doc_id long, text string, lang string")
    got = {x.doc_id for x in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert got == {x[0] for x in rows + clean}


def test_any_number_of_languages(spark):
    rows = [(100 * k + i, _spoken(k, i), f"l{k}") for k in range(70) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    new = spark.createDataFrame([(k, _spoken(k, 99)) for k in range(70)], "k long, text string")
    got = {x.k: x for x in langid.predict(new, model).collect()}
    assert model.cells.shape[0] == 2 and all(got[k].lang_pred == f"l{k}" for k in range(70))


def plain_spans(t):
    kw = "password|passwd|secret|token|api_?key"
    kw = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", kw)
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        rf"""({kw})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_spans_equal_plain_scan(wide, rows, none):
    got = {r.doc_id: r for r in secrets.scan(wide).collect()}
    for d, t, *_ in rows:
        plain = plain_spans(t or "")
        assert got[d].base_sha256 == hashlib.sha256(plain.encode()).hexdigest(), d
        assert set(filter(None, plain.split(","))) <= set(got[d].spans.split(","))
    assert got[210].n_assign == 1 and got[211].n_access == 1 and got[212].n_hex == 1
    assert got[213].n_assign == 0  # the first match is too short and takes the second's start
    assert secrets.scan(none).count() == 0


def test_redact(wide, rows):
    out = secrets.redact(wide)
    assert out.columns == wide.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[210].text.endswith(' [SECRET]"') and got[210].n_chars == len(got[210].text)
    assert got[211].text.endswith(" [SECRET] tail é") and got[212].text.endswith(" [SECRET]")
    assert got[200].text is None and got[1].text == dict((r[0], r[1]) for r in rows)[1]


def test_automata_learn_the_format_and_find_it_without_the_keyword(spark):
    r = random.Random(5)

    def key():
        return "gk-" + "".join(r.choice("0123456789abcdef") for _ in range(24))

    rows = [(i, f"some words token = {key()} and more") for i in range(300)]
    rows += [(1000 + i, f"order 20{i:06d}-{r.randint(0, 9)}-item{i}xyzabc is here") for i in range(300)]
    bare = {2000 + i: key() for i in range(20)}
    rows += [(i, f"look at {v}.") for i, v in bare.items()]
    got = {x.doc_id: x.spans for x in secrets.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == f"learned:8:{8 + len(v)}" for i, v in bare.items()) >= 18
    assert sum("learned" in got[1000 + i] for i in range(300)) == 0
    m = secrets.Automaton([key() for _ in range(300)])
    assert len(m.to) < 60 and m.rate(key()) > -4 and m.log_likelihood("GK-00") == float("-inf")
    for q in range(len(m.to)):  # each state's chances sum to one
        assert m.end[q] + sum(m.n[q].values()) == m._total(q)


def test_rare_labels_and_short_values_train_at_any_size(spark):
    """60 labelled values among 30,000 documents, and labelled values of 12 characters."""
    from pyspark.sql import functions as F

    r = random.Random(6)

    def key(n):
        return "gk-" + "".join(r.choice("0123456789abcdef") for _ in range(n))

    few = [(i, f"some words token = {key(24)} and more") for i in range(60)]
    plain = spark.range(1000, 31000, 1, 4).select("id", F.concat(
        F.lit("some text order-"), F.col("id").cast("string")).alias("text"))
    docs = spark.createDataFrame(few, "id long, text string").unionByName(plain)
    models = secrets.learn(docs.withColumnRenamed("id", "doc_id"))
    assert models["assign"].n[0] == {"g": 60} and models["assign"].shortest == 27

    rows = [(i, f"my token = {key(9)} here") for i in range(300)]
    rows += [(1000 + i, f"part no-{r.randint(10000, 99999)}x was sent") for i in range(300)]
    models = secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    rows += [(2000 + i, f"look at {key(9)} now") for i in range(20)]
    got = {x.doc_id: x.spans for x in secrets.scan(
        spark.createDataFrame(rows, "doc_id long, text string"), models).collect()}
    assert sum(got[2000 + i] == "learned:8:20" for i in range(20)) >= 18
    assert not any(got[1000 + i] for i in range(300))
