"""Mixing sources to target weights by iterative proportional fitting, built-ins only.

Tokens are summed per cell (source, language, topic). Raking scales the cells in turn to
each dimension's target shares until all hold. A document's weight is its cell's factor;
it is sampled with the probability weight / (largest weight), so the sample has the target
shares in expectation. Cells, not documents, take part in the iteration.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch

_log = logging.getLogger(__name__)

DIMS = ("source", "lang", "topic")
#: Topics of documents without a topic column: the first whose marker the text contains.
TOPICS = [("contact", "@"), ("table", " | "), ("license", "icense"), ("web", "://")]
NO_TOPIC, NO_VALUE = "prose", "(none)"
#: A number damps the observed token shares to that power; a mapping names shares, and
#: values that it doesn't name keep their proportions in the rest.
TARGETS: dict[str, float | dict[str, float]] = {
    "source": 0.5,
    "lang": {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.1},  # 0.05 for all others
    "topic": 0.8,
}
TOLERANCE, MAX_SWEEPS = 1e-12, 100
UNMET = 1e-6  # gap between a share and its target from which on a warning is logged


def topic_of(text: Column) -> Column:
    out = F.lit(NO_TOPIC)
    for name, marker in reversed(TOPICS):
        out = F.when(F.contains(text, F.lit(marker)), F.lit(name)).otherwise(out)
    return out


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    h = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(float(1 << 32))


def _features(docs: DataFrame, topic: str | None) -> list[Column]:
    text = F.col("text").cast("string")
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) \
        if c in docs.columns else F.lit(NO_VALUE)
    return [
        value("source").alias("source"), value("lang").alias("lang"),
        (value(topic) if topic else topic_of(text)).alias("topic"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
        .cast("long").alias("n_tokens")]


def _marginals(rows: DataFrame, dims, value: str) -> DataFrame:
    """(dim, value, s): the sum of a column for every value of every dimension."""
    out = None
    for d in dims:
        one = rows.groupBy(F.col(d).alias("value")).agg(F.sum(value).cast("double").alias("s"))
        one = one.select(F.lit(d).alias("dim"), "value", "s")
        out = one if out is None else out.unionByName(one)
    return out


def _goals(cells: DataFrame, targets: dict, scratch: Scratch) -> DataFrame:
    """(dim, value, share): target shares of the values present; each dimension's sum to 1."""
    seen = _marginals(cells, targets, "n_tokens")
    raw, named = F.col("s"), F.lit(None).cast("double")
    for d, spec in targets.items():
        if isinstance(spec, dict):
            for k, v in spec.items():
                named = F.when((F.col("dim") == d) & (F.col("value") == k), float(v)).otherwise(named)
        else:
            raw = F.when(F.col("dim") == d, F.pow("s", F.lit(float(spec)))).otherwise(raw)
    seen = scratch.table(seen.select("dim", "value", raw.alias("raw"), named.alias("named")), "seen")
    sums = {r["dim"]: r for r in seen.groupBy("dim").agg(  # one row per dimension
        F.sum(F.when(F.col("named").isNull(), F.col("raw"))).alias("rest"),
        F.sum("named").alias("named")).collect()}
    share = F.lit(0.0)
    for d, spec in targets.items():
        got = sums.get(d)
        if got is None:
            continue
        rest, fixed = got["rest"] or 0.0, got["named"] or 0.0
        left = max(0.0, 1 - sum(spec.values())) if isinstance(spec, dict) else 1.0
        whole = fixed + (left if rest else 0.0) or 1.0
        share = F.when(F.col("dim") == d, F.coalesce(
            F.col("named"), F.col("raw") * F.lit(left / (rest or 1.0))) / F.lit(whole)).otherwise(share)
    return scratch.table(seen.select("dim", "value", share.alias("share")), "goals")


def rake(cells: DataFrame, targets: dict, scratch: Scratch) -> DataFrame:
    """``cells`` (dimensions, n_tokens) with ``weight``, the factor that brings the shares
    of every dimension to its target. Cells without tokens have weight 0. Targets that no
    weights can reach together (a value all of whose cells have a share of 0 elsewhere) are
    approached until a sweep no longer helps, and the largest gap left is logged."""
    total = cells.agg(F.sum("n_tokens")).first()[0]
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    cells = cells.where("n_tokens > 0")
    goals = _goals(cells, targets, scratch)
    now = cells.withColumn("w", F.col("n_tokens") / F.lit(float(total)))
    for d in targets:
        now = now.join(goals.where(F.col("dim") == d).select(
            F.col("value").alias(d), F.col("share").alias(f"share_{d}")), d)
    now, gaps = scratch.table(now, "cells"), []
    columns = now.columns
    for _ in range(MAX_SWEEPS):
        gaps.append(0.0)
        for d in targets:  # a small plan each: one sum, one join, the gap seen on the way
            seen, share = Observation(), F.col(f"share_{d}")
            nxt = now.join(now.groupBy(d).agg(F.sum("w").alias("s")), d).observe(
                seen, F.max(F.abs(F.col("s") - share)).alias("gap"))
            nxt = nxt.withColumn("w", F.when(F.col("s") > 0, F.col("w") * share / F.col("s"))
                                 .otherwise(0.0)).select(*columns)
            nxt = scratch.table(nxt, "cells")
            gaps[-1] = max(gaps[-1], seen.get["gap"] or 0.0)
            scratch.drop(now)
            now = nxt
        if gaps[-1] <= TOLERANCE or len(gaps) > 3 and gaps[-1] > 0.999 * gaps[-4]:
            break  # reached, or out of reach
    if gaps[-1] > UNMET:
        _log.warning("targets not reached: a share is %.3g off after %d sweeps", gaps[-1], len(gaps))
    now = now.select(*cells.columns, "w")
    return now.withColumn("weight", F.col("w") * F.lit(float(total)) / F.col("n_tokens")).drop("w")


def weigh(docs: DataFrame, targets: dict = TARGETS, topic: str | None = None) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc`` with source, lang, topic, n_tokens, weight, prob
    and kept. ``topic`` names a column of topics; without it topics are told by ``TOPICS``.

    A null source, language or topic is the value ``(none)``; with other values that the
    targets don't name it shares what the named leave. Null, empty and wordless texts have
    no tokens: weight of their cell, or 0 if it has no tokens. Repeated rows weigh each on
    their own; equal ids are drawn alike. Columns that clash with the added ones stay
    inside ``doc``. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("doc"), *_features(docs, topic))
    dims = list(DIMS)
    cells = scratch.table(rows.groupBy(*dims).agg(F.sum("n_tokens").alias("n_tokens")), "cells")
    weight = rake(cells, targets, scratch).select(*dims, "weight")
    top = weight.agg(F.max("weight")).first()[0] or 1.0
    weight = scratch.table(weight.withColumn("prob", F.col("weight") / F.lit(float(top))), "weights")
    out = rows.join(weight, dims, "left")
    prob = F.round(F.coalesce("prob", F.lit(0.0)), 6)
    return out.select("doc", *dims, "n_tokens",
                      F.round(F.coalesce("weight", F.lit(0.0)), 6).alias("weight"),
                      prob.alias("prob"), (draw(F.col("doc.doc_id")) < prob).alias("kept"))


def mix(docs: DataFrame, targets: dict = TARGETS, topic: str | None = None) -> DataFrame:
    """The sampled rows of ``docs``, columns unchanged."""
    return weigh(docs, targets, topic).where("kept").select("doc.*")


def evaluate(docs: DataFrame) -> DataFrame:
    return weigh(docs).select(F.col("doc.doc_id").cast("long").alias("doc_id"), *DIMS, "n_tokens",
                              "weight", "prob", "kept")


def oracle(sweeps: int = 30) -> str:
    topic = f"'{NO_TOPIC}'"
    for name, marker in reversed(TOPICS):
        topic = f"CASE WHEN contains(text, '{marker}') THEN '{name}' ELSE {topic} END"
    sql = f"""
WITH d AS (SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source,
                  coalesce(lang, '{NO_VALUE}') AS lang, {topic} AS topic,
                  len(list_filter(regexp_split_to_array(coalesce(text, ''),
                    '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens
           FROM documents),
c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS t FROM d GROUP BY ALL
      HAVING sum(n_tokens) > 0),
w0 AS (SELECT *, t / sum(t) OVER () AS w FROM c)"""
    for dim, spec in TARGETS.items():
        if isinstance(spec, dict):
            named = "CASE " + " ".join(
                f"WHEN {dim} = '{k}' THEN {v}" for k, v in spec.items()) + " END"
            left = max(0.0, 1 - sum(spec.values()))
            raw = f"coalesce({named}, t * {left} / sum(t) FILTER ({named} IS NULL) OVER ())"
        else:
            raw = f"pow(t, {spec})"
        sql += f""",
raw_{dim} AS (SELECT {dim}, {raw} AS r FROM
              (SELECT {dim}, sum(t) AS t FROM c GROUP BY {dim})),
g_{dim} AS (SELECT {dim}, r / sum(r) OVER () AS share FROM raw_{dim})"""
    n = 0
    for _ in range(sweeps):
        for dim in TARGETS:
            sql += f""",
w{n + 1} AS MATERIALIZED (SELECT source, lang, topic, t,
  w * share / sum(w) OVER (PARTITION BY {dim}) AS w FROM w{n} JOIN g_{dim} USING ({dim}))"""
            n += 1
    return sql + f""",
f AS (SELECT source, lang, topic, w * (SELECT sum(t) FROM c) / t AS weight FROM w{n}),
j AS (SELECT d.*, round(coalesce(weight, 0), 6) AS weight,
             round(coalesce(weight / (SELECT max(weight) FROM f), 0), 6) AS prob
      FROM d LEFT JOIN f USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, weight, prob,
       ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < prob AS kept
FROM j
"""
