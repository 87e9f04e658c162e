"""Job parameters: defaults, overrides, empty = missing, booleans, lists, secrets."""

import dataclasses

import pytest

from lakeferry.plans.params import IngestParams, MaintainParams, parse_predicates


def test_ingest_defaults():
    p = IngestParams.from_env({})
    assert p.brokers == "localhost:9092"
    assert p.topic == "messages"
    assert p.table_path == "s3a://your-bucket/messages/"
    assert p.checkpoint == "s3a://your-bucket/checkpoints/"


def test_ingest_overrides_and_empty_is_missing():
    p = IngestParams.from_env({"KAFKA_BROKERS": "north:19092,south:19092,east:19092",
                               "KAFKA_TOPIC": "", "S3_BUCKET": "b"})
    assert p.brokers == "north:19092,south:19092,east:19092"
    assert p.topic == "messages"
    assert p.table_path == "s3a://b/messages/"
    assert p.checkpoint == "s3a://b/checkpoints/"


def test_one_path_for_both_jobs():
    env = {"TABLE_PATH": "s3a://x/t/"}
    assert IngestParams.from_env(env).table_path == MaintainParams.from_env(env).table_path


def test_secrets_not_printed():
    p = IngestParams.from_env({"S3_ACCESS_KEY": "AKEY", "S3_SECRET_KEY": "SKEY"})
    assert "AKEY" not in repr(p) and "SKEY" not in repr(p)
    m = MaintainParams.from_env({"S3_SECRET_KEY": "SKEY"})
    assert "SKEY" not in repr(m)


def test_maintain_defaults():
    m = MaintainParams.from_env({})
    assert m.compact_by_partition and m.vacuum and m.generate_statistics
    assert m.days_to_compact == 7 and m.vacuum_retention_hours == 168
    assert m.specific_partitions == ()


@pytest.mark.parametrize("text,want", [("TRUE", True), ("true", True), ("False", False),
                                       ("yes", False), ("1", False)])
def test_booleans(text, want):
    assert MaintainParams.from_env({"VACUUM_ENABLED": text}).vacuum is want


def test_bad_integer_raises():
    with pytest.raises(ValueError):
        MaintainParams.from_env({"DAYS_TO_COMPACT": "seven"})


def test_predicate_lists():
    m = MaintainParams.from_env({"SPECIFIC_PARTITIONS":
                                 "partition_message_type = 'view' , partition_date < '2023'"})
    assert m.specific_partitions == ("partition_message_type = 'view'", "partition_date < '2023'")
    assert parse_predicates("a = 1, b = 2 ,c = 3") == ["a = 1", "b = 2", "c = 3"]
    assert parse_predicates("") == []


def test_frozen():
    m = MaintainParams()
    with pytest.raises(dataclasses.FrozenInstanceError):
        m.days_to_compact = 3


def test_older_table_path_name_is_accepted():
    assert MaintainParams.from_env({"DELTA_TABLE_PATH": "s3a://old/t/"}).table_path == "s3a://old/t/"
    both = {"DELTA_TABLE_PATH": "s3a://old/t/", "TABLE_PATH": "s3a://new/t/"}
    assert IngestParams.from_env(both).table_path == "s3a://new/t/"


def test_three_tiers():
    env = {"KAFKA_TOPIC": "from_env", "S3_BUCKET": ""}
    conf = {"spark.lakeferry.kafka.topic": "from_conf", "spark.lakeferry.s3.bucket": "conf-bucket",
            "spark.lakeferry.processing.time": "30 seconds", "spark.lakeferry.s3.ssl": "TRUE",
            "spark.lakeferry.s3.path.style": "false", "spark.lakeferry.max.per.trigger": "500",
            "spark.lakeferry.kafka.brokers": ""}
    p = IngestParams.from_env(env, conf)
    assert (p.topic, p.table_path) == ("from_env", "s3a://conf-bucket/messages/")
    assert p.brokers == "localhost:9092"  # an empty setting counts as missing too
    assert (p.processing_time, p.max_per_trigger) == ("30 seconds", 500)
    assert p.s3_ssl and not p.s3_path_style
    conf["spark.lakeferry.kafka.topic"] = "later"
    env["KAFKA_TOPIC"] = ""
    assert p.topic == "from_env"  # values are fixed when the parameters are made
    assert IngestParams.from_env(env, conf).topic == "later"
    m = MaintainParams.from_env({}, {"spark.lakeferry.compact.budget.bytes": "1000"})
    assert m.compact_budget_bytes == 1000
    assert MaintainParams.from_env({}, {}).compact_budget_bytes is None


def test_settings_of_a_session(spark):
    from lakeferry.plans.params import session_settings

    assert session_settings(spark) == {}
