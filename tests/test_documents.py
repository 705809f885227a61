import pytest

from changelake.functions.types import Field
from changelake.plans import documents as docs
from changelake.plans.config import Destination, Stream
from changelake.sources.tables import JdbcTables


def test_streams():
    got = docs.streams(
        {
            "streams": [
                {"table": "public.users", "primary_key": ["id"], "destination_table": "users"},
                {
                    "table": "events", "source_topic": "t", "sync_mode": "cdc",
                    "normalize_payload": True, "unknown": 1,
                    "payload_columns": [{"name": "user_id", "type": "INT64"},
                                        {"name": "x", "nullable": False}],
                },
            ]
        }
    )
    assert got == [
        Stream("public.users", primary_key=("id",), destination_table="users"),
        Stream("events", "t", "cdc", True, (Field("user_id", "INT64"), Field("x", "STRING", False))),
    ]
    assert docs.streams({}) == [] and docs.streams({"streams": None}) == []
    with pytest.raises(ValueError):
        docs.streams({"streams": [{"table": "t", "payload_columns": [{"name": "a", "type": "X"}]}]})


def test_destination():
    assert docs.destination({}) == Destination()
    assert docs.destination({"type": "PARQUET", "base_path": "/x", "file_size_mb": 64}) == Destination(
        base_path="/x", file_size_mb=64
    )
    assert docs.destination({"type": "iceberg"}).table_namespace == "changelake.cdc_db"


def test_catalog_settings():
    p = "spark.sql.catalog.changelake"
    got = docs.catalog_settings({"base_path": "/b", "catalog_properties": {"io-impl": "z"}})
    assert got[f"{p}.warehouse"] == "/b" and got[f"{p}.type"] == "hadoop" and got[f"{p}.io-impl"] == "z"
    got = docs.catalog_settings({"warehouse": "/w", "catalog_properties": {"warehouse": "/v"}})
    assert got[f"{p}.warehouse"] == "/v"
    with pytest.raises(ValueError):
        docs.catalog_settings({"catalog_type": "rest"})


def test_source():
    got = docs.source({"database": "d", "username": "u", "password": "p", "schemas": ["a", "b"]})
    assert got == JdbcTables(
        "jdbc:postgresql://localhost:5432/d", {"user": "u", "password": "p"}, ("a", "b")
    )
    topic = docs.source({"type": " Kafka", "bootstrap_servers": "h:1", "checkpoint_records": 5})
    assert topic == docs.TopicSource("h:1", "latest", (), 5, 5000)
    for bad in ({"type": "kafka"}, {"type": "mysql"}):
        with pytest.raises(ValueError):
            docs.source(bad)
