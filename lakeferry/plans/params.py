"""Job parameters: frozen dataclasses, filled from keyword arguments or the environment.

Precedence has three tiers, as in the jobs this library replaces: a non-empty environment
variable wins, then a non-empty Spark setting (``KAFKA_TOPIC`` is
``spark.lakeferry.kafka.topic``, given with ``--conf`` or in ``spark-defaults.conf``), then
the default applies. Booleans are
true only for "true" in any letter case. Integers that do not parse raise. Secrets are
never part of the printed form.
"""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Mapping

# Environment variable names and defaults of the two jobs.
ENV_DEFAULTS = {
    "KAFKA_BROKERS": "localhost:9092",
    "KAFKA_TOPIC": "messages",
    "S3_ENDPOINT": "",
    "S3_ACCESS_KEY": "",
    "S3_SECRET_KEY": "",
    "S3_BUCKET": "your-bucket",
    "S3_PATH_STYLE": "true",
    "S3_SSL": "false",
    "TABLE_PATH": "",
    "DELTA_TABLE_PATH": "",
    "CHECKPOINT_LOCATION": "",
    "PROCESSING_TIME": "",
    "MAX_PER_TRIGGER": "",
    "COMPACT_BY_PARTITION": "true",
    "DAYS_TO_COMPACT": "7",
    "SPECIFIC_PARTITIONS": "",
    "COMPACT_BUDGET_BYTES": "",
    "VACUUM_ENABLED": "true",
    "VACUUM_RETENTION_HOURS": "168",
    "GENERATE_STATISTICS": "true",
}


class Settings:
    """Looks names up in the environment, then in Spark settings, then in the defaults."""

    def __init__(self, env: Mapping[str, str] | None = None, conf: Mapping[str, str] | None = None):
        self.env, self.conf = os.environ if env is None else env, conf or {}

    def __getitem__(self, name: str) -> str:
        return self.env.get(name) or self.conf.get(conf_key(name)) or ENV_DEFAULTS.get(name, "")

    def number(self, name: str) -> int | None:
        return int(self[name]) if self[name] else None

    def flag(self, name: str) -> bool:
        return parse_bool(self[name])

    def table_path(self) -> str:
        """``TABLE_PATH``, else ``DELTA_TABLE_PATH`` (the maintenance job's older name), else
        the bucket's ``messages/`` folder — one path for both jobs."""
        return (self["TABLE_PATH"] or self["DELTA_TABLE_PATH"]
                or f"s3a://{self['S3_BUCKET']}/messages/")

    def object_store(self) -> dict:
        return dict(s3_endpoint=self["S3_ENDPOINT"], s3_access_key=self["S3_ACCESS_KEY"],
                    s3_secret_key=self["S3_SECRET_KEY"], s3_path_style=self.flag("S3_PATH_STYLE"),
                    s3_ssl=self.flag("S3_SSL"))


def conf_key(name: str) -> str:
    """The Spark setting of an environment name."""
    return "spark.lakeferry." + name.lower().replace("_", ".")


def session_settings(spark) -> dict[str, str]:
    """The library's own settings of a session: those it was started with."""
    return {k: v for k, v in spark.sparkContext.getConf().getAll()
            if k.startswith("spark.lakeferry.")}


def parse_bool(text: str) -> bool:
    return text.strip().lower() == "true"


def parse_predicates(text: str) -> list[str]:
    """Predicates separated by ``;``, as on the command line, or by commas where there is
    no ``;``. An IN list needs the first form (a trailing ``;`` is enough)."""
    sep = ";" if ";" in (text or "") else ","
    return [p.strip() for p in text.split(sep) if p.strip()] if text else []


@dataclasses.dataclass(frozen=True)
class IngestParams:
    brokers: str = ENV_DEFAULTS["KAFKA_BROKERS"]
    topic: str = ENV_DEFAULTS["KAFKA_TOPIC"]
    table_path: str = "s3a://your-bucket/messages/"
    checkpoint: str = "s3a://your-bucket/checkpoints/"
    s3_endpoint: str = ""
    s3_access_key: str = dataclasses.field(default="", repr=False)
    s3_secret_key: str = dataclasses.field(default="", repr=False)
    s3_path_style: bool = True
    s3_ssl: bool = False
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    decode_mode: str = "FAILFAST"
    topic_path: str | None = None  # offline topic directory instead of Kafka
    # records (Kafka offsets) or files (offline topic) per micro-batch; None = no bound.
    # Bounds the first batch of a stream resuming after downtime.
    max_per_trigger: int | None = None
    processing_time: str | None = None  # interval between batches; None = back to back

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None,
                 conf: Mapping[str, str] | None = None, **overrides) -> IngestParams:
        at = Settings(env, conf)
        vals = dict(
            brokers=at["KAFKA_BROKERS"],
            topic=at["KAFKA_TOPIC"],
            table_path=at.table_path(),
            checkpoint=at["CHECKPOINT_LOCATION"] or f"s3a://{at['S3_BUCKET']}/checkpoints/",
            max_per_trigger=at.number("MAX_PER_TRIGGER"),
            processing_time=at["PROCESSING_TIME"] or None,
            **at.object_store(),
        )
        vals.update(overrides)
        return cls(**vals)


@dataclasses.dataclass(frozen=True)
class MaintainParams:
    table_path: str = "s3a://your-bucket/messages/"
    compact_by_partition: bool = True
    days_to_compact: int = 7
    specific_partitions: tuple[str, ...] = ()
    vacuum: bool = True
    vacuum_retention_hours: int = 168
    allow_short_retention: bool = False  # accept a retention under 168 hours
    generate_statistics: bool = True
    # bytes one compaction may rewrite, best files-per-byte first; None = no bound
    compact_budget_bytes: int | None = None
    per_partition: bool = False  # one job per target, failures isolated
    as_of: str | None = None  # the "today" of the recent-partition window
    s3_endpoint: str = ""
    s3_access_key: str = dataclasses.field(default="", repr=False)
    s3_secret_key: str = dataclasses.field(default="", repr=False)
    s3_path_style: bool = True
    s3_ssl: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None,
                 conf: Mapping[str, str] | None = None, **overrides) -> MaintainParams:
        at = Settings(env, conf)
        vals = dict(
            table_path=at.table_path(),
            compact_by_partition=at.flag("COMPACT_BY_PARTITION"),
            days_to_compact=int(at["DAYS_TO_COMPACT"]),
            specific_partitions=tuple(parse_predicates(at["SPECIFIC_PARTITIONS"])),
            compact_budget_bytes=at.number("COMPACT_BUDGET_BYTES"),
            vacuum=at.flag("VACUUM_ENABLED"),
            vacuum_retention_hours=int(at["VACUUM_RETENTION_HOURS"]),
            generate_statistics=at.flag("GENERATE_STATISTICS"),
            **at.object_store(),
        )
        vals.update(overrides)
        if isinstance(vals.get("specific_partitions"), list):
            vals["specific_partitions"] = tuple(vals["specific_partitions"])
        return cls(**vals)
