import datetime as dt

import pytest

from tidemark import JdbcTable, SyncSpec


def test_write_mode_required_and_checked():
    with pytest.raises(TypeError):
        SyncSpec("p")  # no silent default to overwrite
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="upsert")
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="append", mode="delta")


def test_incremental_needs_watermark_columns():
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="append", mode="incremental")


def test_merge_needs_keys():
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="merge")
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="append", merge_keys=["k"])


def test_rereading_options_only_with_merge():
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="append", mode="incremental", watermark_columns=["ts"], boundary="closed")
    with pytest.raises(ValueError):
        SyncSpec("p", write_mode="append", mode="incremental", watermark_columns=["ts"],
                 lookback=dt.timedelta(days=1))
    SyncSpec("p", write_mode="merge", merge_keys=["k"], mode="incremental", watermark_columns=["ts"],
             boundary="closed", lookback=dt.timedelta(days=1))


def test_jdbc_needs_exactly_one_of_table_or_query():
    with pytest.raises(ValueError):
        JdbcTable("jdbc:derby:memory:x")
    with pytest.raises(ValueError):
        JdbcTable("jdbc:derby:memory:x", table="T", query="SELECT 1")
    with pytest.raises(ValueError):
        JdbcTable("jdbc:derby:memory:x", query="SELECT 1")  # a query needs a name for its state key
    JdbcTable("jdbc:derby:memory:x", query="SELECT 1", name="q")


def test_spec_from_a_parsed_config():
    from tidemark import spec_from_config

    spec = spec_from_config({
        "pipeline_id": "hdr", "description": "header",
        "sync_config": {"mode": "incremental", "watermark_columns": ["made_on"], "write_mode": "merge",
                        "merge_keys": ["row_key"], "partitions": 4, "fetch_size": 10000},
        "transformations": [{"type": "filter", "condition": "x > 0"}, {"type": "rename", "mapping": {"a": "b"}}],
    })
    assert spec.mode == "incremental" and spec.merge_keys == ("row_key",) and len(spec.transforms) == 2
    with pytest.raises(ValueError):
        spec_from_config({"pipeline_id": "x", "sync_config": {"mode": "full"}})
