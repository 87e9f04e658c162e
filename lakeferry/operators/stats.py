"""Counts and partition selection over the message table.

All of these read only the partition columns, so the Parquet scan reads no data columns,
and filters on the keys become partition filters (directories are pruned before listing).
Each aggregate is partial per task, then merged after a shuffle of at most one row per
key per task — a key holding a third of the rows costs no more than any other.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.schema import PARTITION_KEYS

TYPE_KEY, DATE_KEY = PARTITION_KEYS


def total_rows(table: DataFrame) -> DataFrame:
    """One row: ``row_count`` of the whole table."""
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def total_row_count(table: DataFrame) -> int:
    """The total as a number (first row of :func:`total_rows`)."""
    return total_rows(table).first()["row_count"]


def partition_row_counts(table: DataFrame) -> DataFrame:
    """Rows per (type, date) partition, newest date first, then type ascending."""
    return (
        table.groupBy(TYPE_KEY, DATE_KEY)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col(DATE_KEY).desc(), F.col(TYPE_KEY).asc())
    )


def count_where(table: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Several filtered counts in one pass: ``{"alias": predicate}`` -> one row."""
    return table.agg(*[F.count_if(p).alias(name) for name, p in named.items()])


def count_by_type(table: DataFrame, types: dict[str, str], column: str = TYPE_KEY) -> DataFrame:
    """Rows of each given type, one pass: ``{"click_rows": "click", …}`` -> one row.

    The ``IN`` filter on the partition key prunes every other type's directories before
    the scan; the per-type counts are then taken together over what is left.
    """
    wanted = table.where(F.col(column).isin(list(types.values())))
    return count_where(wanted, {name: F.col(column) == F.lit(v) for name, v in types.items()})


def date_window(days: int, as_of: str | _dt.date | None = None) -> tuple[str, str]:
    """Inclusive text bounds ``[as_of - days, as_of]``: ``days`` back covers days+1 dates.

    ``as_of`` defaults to the driver's local date, as the maintenance job runs "today".
    """
    if days < 0:
        raise ValueError("days must be >= 0")
    if as_of is None:
        end = _dt.date.today()
    elif isinstance(as_of, str):
        end = _dt.date.fromisoformat(as_of)
    else:
        end = as_of
    return (end - _dt.timedelta(days=days)).isoformat(), end.isoformat()


def window_dates(days: int, as_of=None) -> list[str]:
    """Every date of ``[as_of - days, as_of]``, newest first (days+1 values)."""
    lo, hi = date_window(days, as_of)
    end = _dt.date.fromisoformat(hi)
    return [(end - _dt.timedelta(days=i)).isoformat() for i in range(days + 1)]


def in_window(days: int, as_of=None, column: str = DATE_KEY) -> Column:
    """Text range predicate on the date key (dates compare as ``yyyy-MM-dd`` text)."""
    lo, hi = date_window(days, as_of)
    return F.col(column).between(F.lit(lo), F.lit(hi))


def recent_partitions(table: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """Distinct ``partition_date`` values inside the window, newest first."""
    return (
        table.where(in_window(days, as_of))
        .select(DATE_KEY)
        .distinct()
        .orderBy(F.col(DATE_KEY).desc())
    )


def date_predicates(dates: DataFrame) -> list[str]:
    """Render a frame of dates as ``partition_date = '…'`` texts, one per directory name.

    Dates are producers' text, so quotes and backslashes are escaped: a value is only ever
    compared, never parsed.
    """
    quoted = lambda v: str(v).replace("\\", "\\\\").replace("'", "\\'")
    return [f"{DATE_KEY} = '{quoted(r[DATE_KEY])}'" for r in dates.collect()]


def validate_predicates(spark: SparkSession, predicates: list[str]) -> list[str]:
    """Check each predicate against the partition columns only (Spark's analyzer does the
    work on an empty frame); raises on an unknown column or a non-boolean predicate."""
    probe = spark.createDataFrame([], f"{TYPE_KEY} string, {DATE_KEY} string")
    out = []
    for p in predicates:
        p = p.strip()
        if not p:
            continue
        probe.where(F.expr(p)).schema  # analysis only
        out.append(p)
    return out


def any_of(predicates: list[str]) -> Column:
    """OR of predicate texts (false for an empty list)."""
    cond = F.lit(False)
    for p in predicates:
        cond = cond | F.expr(f"({p})")
    return cond
