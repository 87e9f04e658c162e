"""Whitening, periodic runs and personal data against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeferry.llm import periodic, pii, whitening

# --- periodic runs ---------------------------------------------------------------------


def brute_runs(w):
    """Every maximal stretch with period q whose smallest period is q."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((i, j - i, q) for (i, j), q in out.items())


@pytest.mark.parametrize("piece", [1, 3, 7, 1 << 16])
def test_runs_equal_brute_force(piece, monkeypatch):
    monkeypatch.setattr(periodic, "PIECE_WORDS", piece)
    r = random.Random(piece)
    for case in range(400 if piece > 1 else 120):
        n, k = r.randint(0, 70), r.choice([1, 2, 2, 3, 5])
        w = [r.randrange(k) for _ in range(n)]
        if case % 2 and n > 8:  # a planted repetition, maybe broken once
            a, p = r.randrange(n), r.randint(1, max(1, n // 4))
            w = w[:a] + [w[a + (i % p)] if a + i % p < n else 0 for i in range(n - a)]
            if case % 4 == 1:
                w[r.randrange(n)] = k
        assert periodic.find_runs(np.array(w, np.int64)) == brute_runs(w), w


def test_runs_of_fibonacci_words_and_long_blocks():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for w in (b, b[:100] * 5 + b[:37], [0] * 300, [0, 1] * 150 + [0], b * 4):
        assert periodic.find_runs(np.array(w, np.int64)) == brute_runs(w)


def brute_document(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w) if n < 3000 else None
    if runs is None:
        return None
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_query_equals_brute_force(spark, rows, wide, none):
    got = {}
    out = periodic.evaluate(wide)
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.n_runs, r.start, r.length, r.period,
                                             r.exponent_milli, r.runs_sha256, r.collapsed_sha256))
    assert sum(map(len, got.values())) == len(rows)
    checked = 0
    for doc_id, text, *_ in rows:
        want = brute_document(doc_id, text)
        if want is not None:
            assert want in got[doc_id], doc_id
            checked += want[0]
    assert checked >= 5
    assert periodic.evaluate(none).schema == out.schema
    assert periodic.evaluate(none).count() == 0


def test_collapse_keeps_columns_and_texts(spark):
    text = "x " * 20 + "endé a b a b a b a b a b stop €"
    df = spark.createDataFrame([(1, text, "k"), (2, "one two", None), (3, None, "n")],
                               "doc_id long, text string, runs string")
    got = {r.row.doc_id: r for r in periodic.collapse(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 20, 1), (21, 10, 2)]
    assert got[1].collapsed == "x endé a b stop €" and got[1].row.runs == "k"
    assert (got[2].collapsed, got[2].n_words, got[2].runs) == ("one two", 2, [])
    assert (got[3].collapsed, got[3].n_words, got[3].row.text) == ("", 0, None)


def test_very_long_periodic_text(spark):
    text = " ".join(f"w{i % 30_011}" for i in range(150_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = periodic.collapse(df, ["doc_id"]).first()
    assert [tuple(x) for x in r.runs] == [(0, 150_000, 30_011)]
    assert r.collapsed == " ".join(f"w{i}" for i in range(30_011))


# --- personal data ---------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text:
            continue  # the pattern is quadratic in a long word
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "phone": 9 <= len(d) <= 15,
                    "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                    "card": 13 <= len(d) <= 19 and sum(
                        sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])
                    ) % 10 == 0}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_patterns(monkeypatch):
    r = random.Random(5)
    alphabets = ["0123456789.. ", "01 -", "a@.b@-", "+1 ().-2", "@a.1+ -9é\n_%", "4 -1"]
    for piece in (5, 1 << 20):
        monkeypatch.setattr(pii, "PIECE", piece)
        for i in range(4000):
            a = alphabets[i % len(alphabets)]
            t = "".join(r.choice(a) for _ in range(r.randint(0, 60)))
            assert [s for s in pii.spans(t) if s[0] in pii.BASE] == brute_pii(t), t


@pytest.mark.parametrize("text,kind,value", [
    ("mail ann.lee+x@mail.example.co.uk, now", "email", "ann.lee+x@mail.example.co.uk"),
    ("host 192.168.010.1.", "ip", "192.168.010.1"),
    ("card 4111-1111 1111 1111 ok", "card", "4111-1111 1111 1111"),
    ("call +1 (988) 555-2485 or", "phone", "+1 (988) 555-2485"),
    ("see http://[2001:db8::7]:80/x", "ipv6", "2001:db8::7"),
    ("IBAN: DE89 3704 0044 0532 0130 00 please", "iban", "DE89 3704 0044 0532 0130 00"),
    ("Social security number 123-45-6789.", "ssn", "123-45-6789"),
    ("my account no. 0012345678,", "account", "0012345678"),
])
def test_each_kind_is_found(text, kind, value):
    assert [text[s:e] for k, s, e in pii.spans(text) if k == kind] == [value]


@pytest.mark.parametrize("text", [
    "IBAN DE89 3704 0044 0532 0130 01", "lessnkh 123-45-6789", "ssn 000-12-3456",
    "accountant 12345678", "account 12345", "http://[nothing]/", "v 1.2.3 and 999.1.1.1",
    "4111 1111 1111 1112", "+12 34", "a@b", "@b.c"])
def test_near_misses_are_left(text):
    assert pii.spans(text) == []


def test_pii_query_and_redaction(spark, rows, wide, none):
    extra = [(900, "x é mail bo@ex.org or 10.0.0.255 and +49 (30) 123-4567", "en", "s", 1),
             (901, "4111 1111 1111 1111 " * 3, "en", "s", 1), (902, None, None, None, None),
             (903, "é" * 300_000 + " bo@ex.org", "en", "s", 1)]
    df = wide.select("doc_id", "text", "kept").unionByName(
        spark.createDataFrame([(i, t, "c") for i, t, *_ in extra], "doc_id long, text string, kept string"))
    out = pii.evaluate(df)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text, *_ in [*rows, *extra]:
        want = brute_pii(text or "")
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        count = [sum(k == x for k, _, _ in want) for x in PATTERNS]
        assert any(hashlib.sha256(base.encode()).hexdigest() == r.base_sha256 and
                   count == [r.n_email, r.n_ip, r.n_card, r.n_phone] and
                   (r.spans == base or base in r.spans) for r in got[doc_id]), doc_id
    assert pii.evaluate(none).schema == out.schema and pii.evaluate(none).count() == 0
    masked = {r.doc_id: r.text for r in pii.redact(df.where("doc_id >= 900")).collect()}
    assert masked[900] == "x é mail [EMAIL] or [IP] and [PHONE]"
    assert masked[901].count("[CARD]") == 0 or "4111" not in masked[901]
    assert masked[902] is None and masked[903].endswith("é [EMAIL]")


# --- whitening -------------------------------------------------------------------------


def _vectors(n=400, dim=12, seed=3):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(dim, dim)) * np.geomspace(1, 0.05, dim)
    return (r.normal(size=(n, dim)) @ mix).astype(np.float32).tolist()


def test_cholesky_and_jacobi_give_eigenvectors():
    r = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (7, 7), (16, 5), (33, 33)):
        a = r.normal(size=(rank, d)) * np.geomspace(1, 1e-5, rank)[:, None]
        v = a.T @ a
        g = whitening.pivoted_cholesky(v)
        assert g.shape[1] == rank and np.allclose(g @ g.T, v, rtol=0, atol=1e-13 * np.trace(v))
        e, u = whitening.eigen(v)
        want = np.linalg.eigvalsh(v)[::-1][:rank]
        assert np.allclose(e, want, rtol=1e-6, atol=1e-14)
        assert np.allclose(u @ u.T, np.eye(rank), atol=1e-12)
        assert np.allclose(v @ u.T, u.T * e, atol=1e-13 * e[0])


def test_whitening_equals_brute_force(spark):
    vec = _vectors()
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] * 12),
           (904, [1.0, 2.0]), (905, [])]
    data = [(i, v) for i, v in enumerate(vec)] + [(500 + i, vec[7]) for i in range(60)]
    data += [(7, vec[7]), (None, vec[9])]
    df = spark.createDataFrame([(i, v, "c", "d") for i, v in data + bad],
                               "vec_id long, embedding array<float>, whitened string, x string")
    out = whitening.evaluate(df.repartition(5))
    got = out.collect()
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in data])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == 12 * len(data)
    w = (x - s / n) @ u / np.sqrt(e)
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for c in range(12):
        sign = np.sign(by[c + 1][0][0].whitened * w[0, c])
        for (i, _), row, want in zip(data, x, w[:, c]):
            for r in by[c + 1][i]:
                assert r.n == n and r.deviation is not None
            assert any(abs(r.whitened * sign - want) < 1e-8 and r.deviation == sum(
                (n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for r in by[c + 1][i])
            assert abs(by[c + 1][i][0].explained - e[c] / e.sum()) < 1e-10
    assert got[0].identity_error < 1e-10
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]


def test_whitening_without_spread_and_with_huge_entries(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert whitening.evaluate(none).count() == 0
    assert whitening.evaluate(none).schema["whitened"].dataType.simpleString() == "double"
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    assert whitening.evaluate(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)
    rows = whitening.evaluate(line).collect()
    assert {r.component for r in rows} == {1} and abs(rows[0].explained - 1) < 1e-12
    huge = spark.createDataFrame([(1, [1e11, 1.0]), (2, [-1e11, 2.0]), (3, [0.0, 0.5]),
                                  (4, [1e30, 0.0])], schema)
    rows = whitening.evaluate(huge).collect()
    assert {r.vec_id for r in rows} == {1, 2, 3}
    assert all(r.deviation is None for r in rows if r.vec_id != 3)
    assert rows[0].identity_error < 1e-4


def test_transform_keeps_all_columns(spark):
    df = spark.createDataFrame([(i, v, "clash") for i, v in enumerate(_vectors(50, 4))],
                               "vec_id long, embedding array<float>, whitened string")
    from lakeferry.llm.common import Scratch

    x, dim = whitening.fit_list(df, "embedding", Scratch(spark))
    model = whitening.fit(x, dim, components=3)
    out = whitening.transform(df, model)
    assert out.where(F.size("whitened") == 3).count() == 50
    assert out.select("row.*").columns == df.columns
