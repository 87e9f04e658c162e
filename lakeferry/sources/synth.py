"""Message fixtures, generated as Spark jobs.

``messages_from_events`` maps the driver's ``events`` table onto the message record (the
stream every registered query replays). ``synth_messages`` is the seeded generator:
given any column of distinct longs it stamps a type drawn from four, a unique UUID-shaped
id and ``base + i`` creation times — it runs where the ids live, never on the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.schema import MESSAGE, MESSAGE_FIELDS

# The message types test fixtures draw from.
FIXTURE_TYPES = ("user_event", "system_event", "error_event", "audit_event")


def epoch_millis(ts: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds of a timestamp column, floor-rounded.

    A zone-less timestamp is read as UTC wall-clock time, independent of the session zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        # calendar parts of a zone-less value never pass through the session zone
        day_ms = F.unix_date(F.to_date(ts)).cast("long") * 86_400_000
        clock_ms = F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
        sec_ms = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long")
        return day_ms + clock_ms + sec_ms
    return F.unix_millis(ts)


def messages_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, event_type, …) -> message records (four fields)."""
    ts_type = events.schema["ts"].dataType
    return events.select(
        F.col("event_type").alias("message_type"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_id").cast("string").alias("message_id"),
        epoch_millis(F.col("ts"), ts_type).alias("creation_time"),
    )


def _uuid_like(i: Column, seed: int) -> Column:
    """UUID-shaped text, unique by construction: the last four digits of the first group and
    the last group are i, all 64 bits of it."""
    hx = F.lpad(F.hex(F.xxhash64(F.lit(seed), F.lit("id"), i)), 16, "0")
    high = F.lpad(F.hex(F.shiftrightunsigned(i.cast("long"), 48)), 4, "0")
    tail = F.lpad(F.hex(i.cast("long").bitwiseAND(F.lit((1 << 48) - 1))), 12, "0")
    return F.lower(
        F.concat(
            F.substring(hx, 1, 4), high, F.lit("-"),
            F.substring(hx, 9, 4), F.lit("-4"),
            F.substring(hx, 13, 3), F.lit("-8"),
            F.substring(hx, 16, 1), F.lit("00-"),
            tail,
        )
    )


def _random_type(i: Column, seed: int, types=FIXTURE_TYPES) -> Column:
    pick = F.pmod(F.xxhash64(F.lit(seed), F.lit("type"), i), F.lit(len(types))) + 1
    return F.element_at(F.array(*[F.lit(t) for t in types]), pick.cast("int"))


def _today() -> str:
    return _dt.date.today().strftime("%Y-%m-%d")


def synth_messages(
    ids: DataFrame,
    id_col: str = "id",
    seed: int = 0,
    date: str | None = None,
    base_ms: int = 1_700_000_000_000,
) -> DataFrame:
    """One message per row of ``ids``: random type (seeded), unique id, ``base + i`` time."""
    i = F.col(id_col).cast("long")
    return ids.select(
        _random_type(i, seed).alias("message_type"),
        F.lit(date or _today()).alias("date"),
        _uuid_like(i, seed).alias("message_id"),
        (F.lit(base_ms) + i).alias("creation_time"),
    )


def messages(spark: SparkSession, n: int, seed: int = 0, date: str | None = None,
             base_ms: int = 1_700_000_000_000) -> DataFrame:
    """``n`` synthetic messages (G2); ``n = 1`` is the single-message fixture (G1)."""
    return synth_messages(spark.range(n), "id", seed, date, base_ms)


def with_types(spark: SparkSession, types: list[str], date: str | None = None,
               seed: int = 0, base_ms: int = 1_700_000_000_000) -> DataFrame:
    """One message per given type, in order (G3)."""
    rows = [(i, t) for i, t in enumerate(types)]
    base = spark.createDataFrame(rows, "i long, t string")
    return base.select(
        F.col("t").alias("message_type"),
        F.lit(date or _today()).alias("date"),
        _uuid_like(F.col("i"), seed).alias("message_id"),
        (F.lit(base_ms) + F.col("i")).alias("creation_time"),
    ).orderBy("creation_time")


def with_dates(spark: SparkSession, dates: list[str], seed: int = 0,
               base_ms: int = 1_700_000_000_000) -> DataFrame:
    """One message per given date, all of one seeded random type, in order (G4)."""
    rows = [(i, d) for i, d in enumerate(dates)]
    base = spark.createDataFrame(rows, "i long, d string")
    return base.select(
        _random_type(F.lit(0).cast("long"), seed).alias("message_type"),
        F.col("d").alias("date"),
        _uuid_like(F.col("i"), seed).alias("message_id"),
        (F.lit(base_ms) + F.col("i")).alias("creation_time"),
    ).orderBy("creation_time")


def literal_messages(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """In-memory message rows (S5); ``rows=[]`` gives the empty frame with the schema (S6)."""
    return spark.createDataFrame(rows, MESSAGE).select(*MESSAGE_FIELDS)
