"""Fixture generators: sizes, uniqueness, order, seeds."""

import uuid

import pytest
from pyspark.sql import functions as F

from lakeferry.sources.synth import (
    FIXTURE_TYPES,
    messages,
    synth_messages,
    with_dates,
    with_types,
)


def _all(df):
    return [tuple(r) for r in df.orderBy("creation_time").collect()]


def test_ids_and_times_are_unique_and_all_types_occur(spark):
    got = messages(spark, 257, seed=11, date="1999-12-31").agg(
        F.count_distinct("message_id"), F.count_distinct("creation_time"),
        F.collect_set("message_type"), F.collect_set("date")).first()
    assert got[0] == got[1] == 257
    assert set(got[2]) == set(FIXTURE_TYPES) and got[3] == ["1999-12-31"]


def test_a_seed_repeats_and_another_differs(spark):
    first, again, other = (_all(messages(spark, 13, seed=s, date="2030-02-28")) for s in (8, 8, 9))
    assert first == again != other


@pytest.mark.parametrize("ids", [[0], [1, 2**48, 2**48 + 1, 2**62, -1, -(2**63), 2**63 - 1]])
def test_ids_are_uuids_over_the_whole_range(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = [r[0] for r in synth_messages(df, "k", seed=2, date="d", base_ms=0).select(
        "message_id").collect()]
    assert len(set(got)) == len(ids) and all(str(uuid.UUID(g)) == g for g in got)


def test_given_types_keep_their_order_and_repeats(spark):
    types = ["zeta", "alpha", "zeta", "zeta", "mid"]
    assert [r[0] for r in _all(with_types(spark, types, date="2031-07-04"))] == types


def test_given_dates_share_a_type(spark):
    dates = ["2020-02-29", "not a date", "", "2020-02-29"]
    rows = _all(with_dates(spark, dates, seed=4))
    assert [r[1] for r in rows] == dates and len({r[0] for r in rows}) == 1


def test_nothing_asked_gives_nothing(spark):
    assert [with_types(spark, []).count(), with_dates(spark, []).count(),
            messages(spark, 0).count()] == [0, 0, 0]


def test_times_count_up_from_the_base(spark):
    assert [r[3] for r in _all(messages(spark, 4, base_ms=-2))] == [-2, -1, 0, 1]
