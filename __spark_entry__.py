"""

Every query runs real syncs over the whole driver tables (read from ``{sf_dir}/*.parquet``)
into fresh tables under the session's shared folder and returns the resulting target (or
check) as a DataFrame. ``oracle_sql`` states the same result in DuckDB SQL over the raw
tables: what the sync must produce, written independently of how it is produced.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as dt

from tidemark import (
    CatalogTable,
    JdbcTable,
    ParquetPath,
    QuerySource,
    RunHistory,
    StateStore,
    SyncSpec,
    ViewTable,
    checks,
    create_namespace,
    from_config,
    namespaces,
    sync,
    sync_chain,
)
from tidemark.functions import marks
from tidemark.workspace import checkpoint_dir, shared_root

# The training-data operators are a subpackage of their own: it, or a library that only it needs, may be absent.
try:
    from tidemark.llm import queries as llm_queries
except ImportError:
    llm_queries = None

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


class Run:
    """A fresh namespace, state and history for one query call."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        if checkpoint_dir(spark) is None and spark.sparkContext.master.startswith("local"):
            # One machine only, and no folder named: on a cluster the shared root is required.
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-local-"))
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        tag = uuid.uuid4().hex[:10]
        self.root = f"{shared_root(spark)}/runs/{tag}"
        self.db = f"tm_{tag}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{self.root}/db'")
        self.state = StateStore(spark, path=f"{self.root}/state")
        self.history = RunHistory(spark, path=f"{self.root}/runs")

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def parquet(self, table: str) -> ParquetPath:
        return ParquetPath(self.path(table), name=table, connection="testdata")

    def query(self, sql: str, name: str) -> QuerySource:
        """SQL over the driver tables, written with ``{orders}``-style placeholders."""
        tables = ("region nation customer supplier part orders lineitem events").split()
        text = sql.format(**{t: f"parquet.`{self.path(t)}`" for t in tables})
        return QuerySource(text, name=name, connection="testdata")

    def table(self, name: str, **kw) -> CatalogTable:
        return CatalogTable(f"{self.db}.{name}", root=f"{self.root}/tables/{name}", **kw)

    def view(self, name: str, **kw) -> ViewTable:
        return ViewTable(f"{self.db}.{name}", root=f"{self.root}/tables/{name}", **kw)

    def sync(self, spec: SyncSpec, source, target, **kw):
        return sync(self.spark, spec, source, target, self.state, self.history, **kw)

    def result(self, target: CatalogTable, source) -> DataFrame:
        """The target, or — when every batch was empty and nothing was ever written — no rows."""
        if target.exists(self.spark):
            return target.read(self.spark)
        return source.read(self.spark).limit(0)


# --- flagship: incremental merge ---------------------------------------------------------

CHANGED_ORDERS = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, "
                  "o_orderdate, o_orderpriority FROM {orders}")


def upto(column: str, text: str):
    return lambda df: df.where(F.col(column) <= F.lit(text).cast("timestamp_ntz"))


def q_merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed the target with orders up to 1999-01-01, then merge a changed source (prices +1)
    beyond the mark 1998-01-01: overlapping orders are replaced, newer ones inserted; a
    repeated run finds nothing new and changes nothing."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("seed_orders", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), target)
    spec = SyncSpec("orders_merge", mode="incremental", write_mode="merge", watermark_columns=["o_orderdate"],
                    merge_keys=["o_orderkey"], initial_mark="1998-01-01")
    changed = r.query(CHANGED_ORDERS, "orders")
    r.sync(spec, changed, target)
    r.sync(spec, changed, target)
    return target.read(spark)


MERGE_INCREMENTAL_SQL = f"""
WITH t AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01'),
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
"""


def q_merge_bucketed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship merge into a target bucketed on the merge key: the anti join reads the
    target bucket by bucket and shuffles only the batch; every version keeps the buckets."""
    r = Run(spark, sf_dir)
    target = r.table("orders", bucket_by=("o_orderkey",), buckets=8)
    r.sync(SyncSpec("seed_orders", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), target)
    spec = SyncSpec("orders_merge", mode="incremental", write_mode="merge", watermark_columns=["o_orderdate"],
                    merge_keys=["o_orderkey"], initial_mark="1998-01-01")
    changed = r.query(CHANGED_ORDERS, "orders")
    r.sync(spec, changed, target)
    r.sync(spec, changed, target)
    return target.read(spark)


# --- full refresh ------------------------------------------------------------------------

def q_full_refresh(spark, sf_dir):
    """Overwrite twice: a partial load, then the whole table (the second replaces the first)."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("orders_full_a", write_mode="overwrite", transforms=(upto("o_orderdate", "1997-01-01"),)),
           r.parquet("orders"), target)
    r.sync(SyncSpec("orders_full", write_mode="overwrite"), r.parquet("orders"), target)
    return target.read(spark)


def q_full_refresh_schema_change(spark, sf_dir):
    """A second overwrite with fewer columns replaces the table's schema."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("orders_full", write_mode="overwrite"), r.parquet("orders"), target)
    r.sync(SyncSpec("orders_narrow", write_mode="overwrite"),
           r.query("SELECT o_orderkey, o_totalprice FROM {orders}", "orders_narrow"), target)
    return target.read(spark)


# --- incremental filters -----------------------------------------------------------------

def q_incremental_filter_timestamp(spark, sf_dir):
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("orders_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="2000-01-01 00:00:00"), r.parquet("orders"), target)
    return target.read(spark)


TWO_MARKS = ("SELECT o_orderkey, o_totalprice, "
             "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS created, "
             "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate + INTERVAL 30 DAYS END AS modified "
             "FROM {orders}")
TWO_MARKS_SQL = ("SELECT o_orderkey, o_totalprice, "
                 "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS created, "
                 "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS modified "
                 "FROM orders")


def _two_marks_sync(spark, sf_dir):
    r = Run(spark, sf_dir)
    target = r.table("orders_marks")
    spec = SyncSpec("orders_two_marks", mode="incremental", write_mode="append",
                    watermark_columns=["created", "modified"], initial_mark="2000-06-01")
    r.sync(spec, r.query(TWO_MARKS, "orders_marks"), target)
    return r, target


def q_incremental_filter_multi(spark, sf_dir):
    """Two watermark columns with NULLs: a row is new when either column is beyond the mark."""
    r, target = _two_marks_sync(spark, sf_dir)
    return target.read(spark)


def q_max_mark(spark, sf_dir):
    """The stored mark after the two-column sync: max(greatest(created, modified))."""
    r, _ = _two_marks_sync(spark, sf_dir)
    return r.state.current("orders_two_marks").select(
        F.col("watermark_value_timestamp_ntz").alias("max_mark"), F.col("last_record_count").alias("records"))


def q_incremental_filter_numeric(spark, sf_dir):
    """Numeric mark (event_id), two batches: upstream as of 2024-01-16, then all of it."""
    r = Run(spark, sf_dir)
    target = r.table("events")
    spec = SyncSpec("events_by_id", mode="incremental", write_mode="append", watermark_columns=["event_id"])
    r.sync(spec, r.query("SELECT * FROM {events} WHERE ts < TIMESTAMP '2024-01-16 00:00:00'", "events"), target)
    r.sync(spec, r.parquet("events"), target)
    return target.read(spark)


def q_incremental_filter_string(spark, sf_dir):
    """Text marks: a string column compared as text, and a datetime text on a timestamp column."""
    r = Run(spark, sf_dir)
    customers, events = r.table("customers"), r.table("events")
    r.sync(SyncSpec("customers_by_name", mode="incremental", write_mode="append", watermark_columns=["c_name"],
                    initial_mark="Customer#000000999"), r.parquet("customer"), customers)
    r.sync(SyncSpec("events_since", mode="incremental", write_mode="append", watermark_columns=["ts"],
                    initial_mark="2024-01-20 12:30:00"), r.parquet("events"), events)
    found_customers = r.result(customers, r.parquet("customer"))
    found_events = r.result(events, r.parquet("events"))
    return (found_customers.select(F.lit("customer").alias("src"), F.col("c_custkey").alias("id"))
            .unionByName(found_events.select(F.lit("events").alias("src"), F.col("event_id").alias("id"))))


def q_incremental_custom_query(spark, sf_dir):
    """A custom query (projection + predicates) is itself filtered by the mark."""
    r = Run(spark, sf_dir)
    target = r.table("orders_f_urgent")
    src = r.query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM {orders} "
                  "WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'", "orders_f_urgent")
    r.sync(SyncSpec("custom_query", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="1999-01-01"), src, target)
    return target.read(spark)


# --- incremental append ------------------------------------------------------------------

EVENTS_AS_OF = "SELECT * FROM {events} WHERE ts < TIMESTAMP '%s'"


def _events_three_batches(spark, sf_dir):
    r = Run(spark, sf_dir)
    target = r.table("events")
    spec = SyncSpec("events_append", mode="incremental", write_mode="append", watermark_columns=["ts"])
    r.sync(spec, r.query(EVENTS_AS_OF % "2024-01-10 00:00:00", "events"), target)
    r.sync(spec, r.query(EVENTS_AS_OF % "2024-01-20 00:00:00", "events"), target)
    r.sync(spec, r.parquet("events"), target)
    r.sync(spec, r.parquet("events"), target)  # nothing new
    return r, target


def q_incremental_append(spark, sf_dir):
    """Events in three batches (upstream as of 01-10, 01-20, now) plus an empty re-run: each row once."""
    r, target = _events_three_batches(spark, sf_dir)
    return target.read(spark)


def q_batch_metrics(spark, sf_dir):
    """Row count and new mark observed while staging each batch (no extra scans)."""
    r, _ = _events_three_batches(spark, sf_dir)
    return (r.history.runs("events_append").where("status = 'SUCCESS' AND records_synced > 0")
            .select("records_synced", F.col("mark_after").cast("timestamp_ntz").alias("mark_after")))


def q_run_monitor(spark, sf_dir):
    """Monitoring over the run history: runs, zero-row runs, failures, long runs, rows synced."""
    r, _ = _events_three_batches(spark, sf_dir)
    return checks.run_monitor(r.history.runs()).drop("last_success")


def q_incremental_append_subsecond(spark, sf_dir):
    """Cut inside a second: marks keep microseconds, so no row is read twice."""
    r = Run(spark, sf_dir)
    target = r.table("events")
    spec = SyncSpec("events_subsecond", mode="incremental", write_mode="append", watermark_columns=["ts"])
    r.sync(spec, r.query(EVENTS_AS_OF % "2024-01-16 00:00:00", "events"), target)
    r.sync(spec, r.parquet("events"), target)
    return target.read(spark)


# --- merge -------------------------------------------------------------------------------

def q_merge_single_key(spark, sf_dir):
    """Full-mode merge on one key: matched rows replaced whole, others inserted, none deleted."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("seed", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), target)
    src = r.query(CHANGED_ORDERS + " WHERE o_orderdate > TIMESTAMP '1998-01-01'", "orders_changed")
    r.sync(SyncSpec("orders_upsert", write_mode="merge", merge_keys=["o_orderkey"]), src, target)
    return target.read(spark)


LINEITEM_PLUS = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, "
                 "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM {lineitem}")
LI_KEYS = ["l_orderkey", "l_linenumber"]


def q_merge_composite_key(spark, sf_dir):
    """Two-column key; lineitem repeats keys, so each batch is reduced to the latest row per key."""
    r = Run(spark, sf_dir)
    target = r.table("lineitem")
    r.sync(SyncSpec("li_seed", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"], transforms=(upto("l_shipdate", "1999-01-01"),)),
           r.parquet("lineitem"), target)
    r.sync(SyncSpec("li_merge", mode="incremental", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"], initial_mark="1998-01-01"),
           r.query(LINEITEM_PLUS, "lineitem"), target)
    return target.read(spark)


def q_merge_latest_wins(spark, sf_dir):
    """Events merged on user_id, newest ts wins (one row per user)."""
    r = Run(spark, sf_dir)
    target = r.table("last_event")
    r.sync(SyncSpec("last_seed", write_mode="merge", merge_keys=["user_id"], duplicate_keys="latest",
                    watermark_columns=["ts"], transforms=(upto("ts", "2024-01-15 00:00:00"),)),
           r.parquet("events"), target)
    r.sync(SyncSpec("last_merge", mode="incremental", write_mode="merge", merge_keys=["user_id"],
                    duplicate_keys="latest", watermark_columns=["ts"], initial_mark="2024-01-15 00:00:00"),
           r.parquet("events"), target)
    return target.read(spark)


def q_merge_partitioned_target(spark, sf_dir):
    """Target partitioned by the merge key: only touched partitions are rewritten."""
    r = Run(spark, sf_dir)
    target = r.table("last_by_type", partition_by=("event_type",))
    r.sync(SyncSpec("type_seed", write_mode="merge", merge_keys=["event_type"], duplicate_keys="latest",
                    watermark_columns=["ts"], transforms=(upto("ts", "2024-01-15 00:00:00"),)),
           r.parquet("events"), target)
    r.sync(SyncSpec("type_merge", mode="incremental", write_mode="merge", merge_keys=["event_type"],
                    duplicate_keys="latest", watermark_columns=["ts"], initial_mark="2024-01-15 00:00:00"),
           r.query("SELECT * FROM {events} WHERE event_type <> 'signup'", "events"), target)
    return target.read(spark)


def q_merge_partitioned_composite(spark, sf_dir):
    """Partitioned by event_type, keyed by (event_type, event_id): the first load is staged
    partitioned; the delta (values +1 beyond 01-20, no signups) updates and inserts, and only
    the touched partitions are rewritten."""
    r = Run(spark, sf_dir)
    keys = ["event_type", "event_id"]
    target = r.table("events_by_type", partition_by=("event_type",))
    r.sync(SyncSpec("ev_seed", write_mode="merge", merge_keys=keys, transforms=(upto("ts", "2024-01-25 00:00:00"),)),
           r.parquet("events"), target)
    r.sync(SyncSpec("ev_delta", mode="incremental", write_mode="merge", merge_keys=keys, watermark_columns=["ts"],
                    initial_mark="2024-01-20"),
           r.query("SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM {events} "
                   "WHERE event_type <> 'signup'", "events"), target)
    return target.read(spark)


def q_merge_partitioned_bucketed(spark, sf_dir):
    """merge_partitioned_composite into a target also bucketed by event_id: only the touched
    partitions are read (bucket by bucket) and rewritten, keeping their bucket files."""
    r = Run(spark, sf_dir)
    keys = ["event_type", "event_id"]
    target = r.table("events_by_type", partition_by=("event_type",), bucket_by=("event_id",), buckets=4)
    r.sync(SyncSpec("ev_seed", write_mode="merge", merge_keys=keys, transforms=(upto("ts", "2024-01-25 00:00:00"),)),
           r.parquet("events"), target)
    r.sync(SyncSpec("ev_delta", mode="incremental", write_mode="merge", merge_keys=keys, watermark_columns=["ts"],
                    initial_mark="2024-01-20"),
           r.query("SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM {events} "
                   "WHERE event_type <> 'signup'", "events"), target)
    return target.read(spark)


NULL_KEYED = ("SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_custkey END AS k, "
              "c_name, c_nationkey, c_acctbal%s AS c_acctbal, c_mktsegment FROM {customer}")


def q_merge_null_keys(spark, sf_dir):
    """NULL keys never match: NULL-key target rows stay and NULL-key batch rows are inserted."""
    r = Run(spark, sf_dir)
    target = r.table("customers")
    r.sync(SyncSpec("cust_seed", write_mode="overwrite"),
           r.query(NULL_KEYED % "" + " WHERE c_nationkey < 13", "customers_a"), target)
    r.sync(SyncSpec("cust_merge", write_mode="merge", merge_keys=["k"]), r.query(NULL_KEYED % " + 1", "customers_b"),
           target)
    return target.read(spark)


def q_merge_into_missing_table(spark, sf_dir):
    """Merge into a missing table creates it from the batch (duplicates cannot match anything)."""
    r = Run(spark, sf_dir)
    target = r.table("lineitem")
    r.sync(SyncSpec("li_first", write_mode="merge", merge_keys=LI_KEYS), r.parquet("lineitem"), target)
    return target.read(spark)


def q_merge_closed_boundary(spark, sf_dir):
    """Rows sharing the mark's value that arrive later are caught with boundary='closed'."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    spec = SyncSpec("orders_ties", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                    watermark_columns=["o_orderdate"], boundary="closed")
    r.sync(spec, r.query("SELECT * FROM {orders} WHERE o_orderdate < TIMESTAMP '1998-06-27' OR "
                         "(o_orderdate = TIMESTAMP '1998-06-27' AND o_orderstatus = 'F')", "orders"), target)
    r.sync(spec, r.parquet("orders"), target)
    return target.read(spark)


def q_late_lookback(spark, sf_dir):
    """Late arrivals below the mark are picked up by a 2-day lookback (merge keeps it idempotent)."""
    r = Run(spark, sf_dir)
    target = r.table("events")
    spec = SyncSpec("events_late", mode="incremental", write_mode="merge", merge_keys=["event_id"],
                    watermark_columns=["ts"], lookback=dt.timedelta(days=2))
    r.sync(spec, r.query("SELECT * FROM {events} WHERE ts < TIMESTAMP '2024-01-16' AND NOT "
                         "(event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15')", "events"), target)
    r.sync(spec, r.parquet("events"), target)
    return target.read(spark)


# --- table-to-table chains ---------------------------------------------------------------

def _chain(spark, sf_dir):
    """header → detail → header facts → detail facts, after one-time historical loads."""
    r = Run(spark, sf_dir)
    ih, idt = r.table("recent_orders"), r.table("recent_lines")
    fh, fd = r.table("all_orders"), r.table("all_lines")
    r.sync(SyncSpec("all_orders_initial", write_mode="overwrite", transforms=(upto("o_orderdate", "2000-06-01"),)),
           r.parquet("orders"), fh)
    r.sync(SyncSpec("all_lines_initial", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"], transforms=(upto("l_shipdate", "2000-06-01"),)),
           r.parquet("lineitem"), fd)
    sync_chain(spark, [
        (SyncSpec("recent_orders", mode="incremental", write_mode="merge", merge_keys=["o_orderkey"],
                  watermark_columns=["o_orderdate"], initial_mark="2000-01-01"), r.query(CHANGED_ORDERS, "orders"), ih),
        (SyncSpec("recent_lines", mode="incremental", write_mode="merge", merge_keys=LI_KEYS,
                  duplicate_keys="latest", watermark_columns=["l_shipdate"], initial_mark="2000-01-01"),
         r.query(LINEITEM_PLUS, "lineitem"), idt),
        (SyncSpec("orders_delta_to_history", write_mode="merge", merge_keys=["o_orderkey"]), ih, fh),
        (SyncSpec("lineitem_delta_to_history", write_mode="merge", merge_keys=LI_KEYS), idt, fd),
    ], r.state, r.history)
    return fh, fd


def q_merge_table_to_table(spark, sf_dir):
    fh, _ = _chain(spark, sf_dir)
    return fh.read(spark)


def q_chained_sync_detail(spark, sf_dir):
    _, fd = _chain(spark, sf_dir)
    return fd.read(spark)


# --- state -------------------------------------------------------------------------------

def q_state_after_sync(spark, sf_dir):
    """State report after three pipelines (newest first), without the wall-clock column."""
    r = Run(spark, sf_dir)
    r.sync(SyncSpec("orders_append", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"]),
           r.parquet("orders"), r.table("orders"))
    spec = SyncSpec("events_by_id", mode="incremental", write_mode="append", watermark_columns=["event_id"])
    r.sync(spec, r.query(EVENTS_AS_OF % "2024-01-16 00:00:00", "events"), r.table("events"))
    r.sync(spec, r.parquet("events"), r.table("events"))
    r.sync(SyncSpec("customers_by_key", mode="incremental", write_mode="merge", merge_keys=["c_custkey"],
                    watermark_columns=["c_nationkey"]), r.parquet("customer"), r.table("customers"))
    return r.state.report().select("pipeline_id", "source_connection", "source_schema", "source_table",
                                   "watermark_column", "watermark_type", "watermark_value_timestamp_ntz",
                                   "watermark_value_bigint", "watermark_value_int", "last_record_count")


LEGACY_FROM_EVENTS = """
SELECT 'events_db' AS databaseName, event_type AS tableName, 'bigint' AS wmType,
       CAST(NULL AS TIMESTAMP) AS timestampWm, max(event_id) AS bigIntWm, CAST(NULL AS INT) AS intWm,
       CAST(NULL AS STRING) AS stringWm
FROM {events} WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY event_type
UNION ALL
SELECT 'users_db', concat('user_', CAST(user_id AS STRING)), 'string', NULL, NULL, NULL, max(props)
FROM {events} GROUP BY user_id
"""


def q_state_legacy_migration(spark, sf_dir):
    """Old-layout state (databaseName, tableName, wmType, …, marks as of 2024-01-16) moved to the
    current layout, then used: an incremental sync of 'click' events continues from its migrated mark."""
    r = Run(spark, sf_dir)
    legacy = r.query(LEGACY_FROM_EVENTS, "legacy").read(spark)
    r.state.migrate(legacy, F.concat(F.lit("legacy_"), F.col("tableName")), "oracle_legacy", "event_id")
    click = QuerySource(r.query("SELECT * FROM {events} WHERE event_type = 'click'", "x").sql,
                        name="click", connection="oracle_legacy", schema_name="events_db")
    r.sync(SyncSpec("legacy_click", mode="incremental", write_mode="append", watermark_columns=["event_id"]),
           click, r.table("clicks"))
    return r.state.current().select("pipeline_id", "source_connection", "source_schema", "source_table",
                                    "watermark_type", "watermark_value_bigint", "watermark_value_string",
                                    "last_record_count")


# --- empty batches and save modes --------------------------------------------------------

def q_empty_batch_noop(spark, sf_dir):
    """Empty incremental and empty full batches write nothing; the target stays as it was."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    inc = SyncSpec("orders_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"])
    r.sync(inc, r.parquet("orders"), target)
    r.sync(inc, r.parquet("orders"), target)
    r.sync(SyncSpec("orders_full", write_mode="overwrite"),
           r.query("SELECT * FROM {orders} WHERE o_orderdate > TIMESTAMP '2100-01-01'", "orders"), target)
    return target.read(spark)


def q_save_modes_ignore_error(spark, sf_dir):
    """'ignore' leaves an existing target alone; 'error' refuses to touch it."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("orders_full", write_mode="overwrite"), r.parquet("orders"), target)
    r.sync(SyncSpec("orders_ignore", write_mode="ignore"), r.parquet("customer"), target)
    try:
        r.sync(SyncSpec("orders_error", write_mode="error"), r.parquet("customer"), target)
    except FileExistsError:
        pass
    else:
        raise AssertionError("write_mode 'error' wrote into an existing table")
    return target.read(spark)


# --- late rows, drill-down, changing columns, namespaces ----------------------------------

def q_late_append_once(spark, sf_dir):
    """An append that re-reads three days: purchases of the last day arrive late and are copied once, rows copied before are not copied again."""
    r = Run(spark, sf_dir)
    target = r.table("events")
    spec = SyncSpec("events_late_append", mode="incremental", write_mode="append", watermark_columns=["ts"], lookback=dt.timedelta(days=3), row_keys=["event_id"])
    late = "(event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15')"
    r.sync(spec, r.query(f"SELECT * FROM {{events}} WHERE ts < TIMESTAMP '2024-01-16' AND NOT {late}", "events"), target)
    r.sync(spec, r.query("SELECT * FROM {events} WHERE ts < TIMESTAMP '2024-01-16'", "events"), target)  # late rows only: the mark may stay
    for _ in range(2):
        r.sync(spec, r.parquet("events"), target)
    return target.read(spark)


def q_reconcile_drilldown(spark, sf_dir):
    """Orders against a copy that lacks some and has some changed: only the differing ranges of keys are compared row by row."""
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    copy = orders.where("o_orderkey % 1000 <> 7").withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 1000 = 13 THEN -o_totalprice ELSE o_totalprice END"))
    return checks.reconcile_drilldown(orders, copy, ["o_orderkey"])


def q_view_schema_evolution(spark, sf_dir):
    """A table whose source gains a column and widens its key from int to bigint between two appends, and is then merged with both."""
    r = Run(spark, sf_dir)
    target = r.view("parts", evolve=True)
    spec = dict(mode="incremental", watermark_columns=["mark"])
    first = "SELECT CAST(p_partkey AS INT) AS p_partkey, p_size, CAST(p_partkey AS BIGINT) AS mark FROM {part} WHERE p_partkey <= 500"
    second = "SELECT p_partkey, p_size, p_brand, p_partkey AS mark FROM {part} WHERE p_partkey <= 1500"
    r.sync(SyncSpec("parts_append", write_mode="append", **spec), r.query(first, "part"), target)
    r.sync(SyncSpec("parts_append", write_mode="append", **spec), r.query(second, "part"), target)
    r.sync(SyncSpec("parts_merge", write_mode="merge", merge_keys=["p_partkey"]),
           r.query("SELECT p_partkey, CAST(p_size AS BIGINT) + 1 AS p_size, p_partkey AS mark, p_retailprice FROM {part} WHERE p_partkey % 10 = 0", "part_prices"), target)
    return target.read(spark)


def q_namespace_listing(spark, sf_dir):
    """A namespace for each region with a table of its nations: created, listed, and read."""
    r = Run(spark, sf_dir)
    regions = [x["r_name"] for x in spark.read.parquet(r.path("region")).select("r_name").collect()]  # a handful of names
    for name in regions:
        space = f"{r.db}_{name.lower().replace(' ', '_')}"
        create_namespace(spark, space, f"nations of {name}", f"{r.root}/{space}")
        target = CatalogTable(f"{space}.nation", root=f"{r.root}/tables/{space}")
        r.sync(SyncSpec(f"nations_{space}", write_mode="overwrite"),
               r.query(f"SELECT n.* FROM {{nation}} n JOIN {{region}} ON n_regionkey = r_regionkey WHERE r_name = '{name}'", f"nation_{space}"), target)
    listed = namespaces(spark, f"{r.db}_*").collect()
    frames = [spark.read.table(f"{x['namespace']}.nation").agg(F.lit(x["namespace"][len(r.db) + 1:]).alias("namespace"), F.lit(x["tables"]).cast("bigint").alias("tables"),
                                                              F.count("*").alias("nations")) for x in listed]
    return reduce(DataFrame.unionByName, frames)


# --- hot keys, unusual runs --------------------------------------------------------------

def q_preflight_hot_keys(spark, sf_dir):
    """Merge keys that hold a two-hundredth of all rows or more: one task would get them all."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    by_user = checks.hot_keys(events, ["user_id"], 0.005).select(F.lit("user_id").alias("key"), F.col("user_id").cast("string").alias("value"), "n")
    by_type = checks.hot_keys(events, ["event_type", "user_id"], 0.0015)
    return by_user.unionByName(by_type.select(F.lit("event_type,user_id").alias("key"), F.concat_ws(",", "event_type", "user_id").alias("value"), "n"))


def q_run_anomalies(spark, sf_dir):
    """Runs judged by their pipeline's last ones. Each user's events of a day are taken as a run, whose seconds are their largest value."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    runs = events.groupBy(F.concat(F.lit("user_"), "user_id").alias("pipeline_id"), F.date_trunc("day", "ts").alias("started_at")).agg(
        F.when(F.count_if(F.col("event_type") == "error") >= 2, "FAILED").otherwise("SUCCESS").alias("status"),
        F.count("*").alias("records_synced"), F.max("value").alias("duration_seconds"))
    found = checks.run_anomalies(runs, last=10, least=3, factor=2.0)
    return found.withColumn("started_at", F.date_format("started_at", "yyyy-MM-dd"))


# --- tables behind a view ----------------------------------------------------------------

def q_merge_touched_files(spark, sf_dir):
    """Composite-key merge into a view clustered by key: the second delta holds a hundredth of the key range, and
    only the files of that range are rewritten."""
    r = Run(spark, sf_dir)
    target = r.view("lineitem", cluster_by=("l_orderkey",))
    r.sync(SyncSpec("li_seed", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"], transforms=(upto("l_shipdate", "1999-01-01"),)),
           r.parquet("lineitem"), target)
    r.sync(SyncSpec("li_merge", mode="incremental", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"], initial_mark="1998-01-01"),
           r.query(LINEITEM_PLUS, "lineitem"), target)
    few = r.query(LINEITEM_PLUS + " WHERE l_orderkey <= (SELECT max(l_orderkey) FROM {lineitem}) / 100", "lineitem_few")
    r.sync(SyncSpec("li_few", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest", watermark_columns=["l_shipdate"]), few, target)
    return target.read(spark)


def q_publish_view_partitions(spark, sf_dir):
    """A partitioned table of a partition for each day: refreshed whole, and again with other columns; each publish is one catalog call."""
    r = Run(spark, sf_dir)
    target = r.view("events_by_day", partition_by=("day",))
    by_day = "SELECT event_id, user_id, value, CAST(CAST(ts AS DATE) AS STRING) AS day FROM {events}"
    r.sync(SyncSpec("days", write_mode="overwrite"), r.query(by_day + " WHERE ts < TIMESTAMP '2024-01-16'", "days"), target)
    r.sync(SyncSpec("days_more", write_mode="overwrite"), r.query(by_day.replace("value,", "value, event_type,"), "days_more"), target)
    return target.read(spark)


# --- runs that meet ----------------------------------------------------------------------

class _Interrupted(QuerySource):
    """A source during whose read something else happens, once."""

    def meanwhile(self, action) -> "_Interrupted":
        object.__setattr__(self, "_action", action)
        return self

    def read(self, spark, predicate=None):
        if predicate is not None and (action := getattr(self, "_action", None)):
            object.__setattr__(self, "_action", None)
            action()
        return super().read(spark, predicate)


def q_state_two_writers(spark, sf_dir):
    """Two runs of one pipeline at once: the one that read less comes second. It fails and publishes nothing, and the mark stays."""
    r = Run(spark, sf_dir)
    target, text = r.table("events"), "SELECT * FROM {events}"
    spec = SyncSpec("events_twice", mode="incremental", write_mode="merge", merge_keys=["event_id"], watermark_columns=["ts"])
    early = r.query(text + " WHERE ts < TIMESTAMP '2024-01-16'", "events")
    slow = _Interrupted(early.sql.replace("SELECT *", "SELECT event_id, ts, user_id, event_type, -1D AS value, props"), early.name, early.connection)
    try:
        r.sync(spec, slow.meanwhile(lambda: r.sync(spec, r.query(text, "events"), target)), target)
    except RuntimeError:
        pass
    state, rows = r.state.current("events_twice"), target.read(spark)
    return _figures(rows=rows.agg(F.count("*")), of_the_late_run=rows.where("value = -1").agg(F.count("*")),
                    failed_runs=r.history.runs("events_twice").where("status = 'FAILED'").agg(F.count("*")),
                    revision=state.select("revision"), records=state.select("last_record_count"),
                    mark=state.select(F.unix_micros(F.col("watermark_value_timestamp_ntz").cast("timestamp"))))


def _figures(**one: DataFrame) -> DataFrame:
    """(what, n) of tables of one row and column each."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(what).alias("what"), F.col(f"`{df.columns[0]}`").cast("bigint").alias("n")) for what, df in one.items()])


def q_chain_one_cut(spark, sf_dir):
    """Orders, then their lines, while new orders and lines arrive between the two steps: with one cut no line is copied before its order.
    The second run of the chain copies the rest."""
    r = Run(spark, sf_dir)
    orders, lines = r.table("orders"), r.table("lines")
    mark = "(SELECT percentile(unix_micros(CAST(o_orderdate AS TIMESTAMP)), 0.5) FROM {orders})"
    header = "SELECT o_orderkey, o_custkey, o_orderdate AS created FROM {orders}"
    detail = "SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate AS created FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey"
    early = f" WHERE unix_micros(CAST(o_orderdate AS TIMESTAMP)) <= {mark}"
    specs = [SyncSpec("chain_orders", mode="incremental", write_mode="append", watermark_columns=["created"]),
             SyncSpec("chain_lines", mode="incremental", write_mode="append", watermark_columns=["created"])]
    first = r.query(detail + early, "lines")
    # by the time the lines are read, all of them are there
    cut_short = [(specs[0], r.query(header + early, "orders"), orders), (specs[1], _Late(r.query(detail, "lines").sql, "lines", "testdata").at_first(first), lines)]
    sync_chain(spark, cut_short, r.state, r.history, cut="latest")
    found = lines.read(spark)
    orphans = found.join(orders.read(spark), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").count()
    first_run = found.count()
    sync_chain(spark, [(specs[0], r.query(header, "orders"), orders), (specs[1], r.query(detail, "lines"), lines)], r.state, r.history, cut="latest")
    found = lines.read(spark)
    return _figures(orphans=found.agg(F.lit(orphans)), first_run=found.agg(F.lit(first_run)), lines=found.agg(F.count("*")),
                    quantity=found.agg(F.sum("l_quantity")), orders=orders.read(spark).agg(F.count("*")))


class _Late(QuerySource):
    """A source that holds less when it is first asked (for the chain's cut) than when it is read."""

    def at_first(self, less: QuerySource) -> "_Late":
        object.__setattr__(self, "_less", less)
        return self

    def read(self, spark, predicate=None):
        less, window = getattr(self, "_less", None), marks.window_of(predicate)
        if less is not None and window is not None and window.upto is None:
            return less.read(spark, predicate)
        return super().read(spark, predicate)


# --- JDBC (Derby, in-process) ------------------------------------------------------------

DERBY_TYPES = "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)"


def derby(r: Run, table: str, **kw) -> JdbcTable:
    """An in-memory Derby database private to this JVM (tests only: no server, no port)."""
    url = f"jdbc:derby:memory:{r.db};create=true"
    opts = {"preferTimestampNTZ": "true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    return JdbcTable(url, table=table, options=opts, column_types=kw.pop("column_types", DERBY_TYPES), **kw)


def derby_query(r: Run, sql: str, name: str, **kw) -> JdbcTable:
    url = f"jdbc:derby:memory:{r.db};create=true"
    opts = {"preferTimestampNTZ": "true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    return JdbcTable(url, query=sql, name=name, options=opts, **kw)


def _export_orders(r: Run) -> JdbcTable:
    """Catalog → JDBC: a historical full export, then an incremental append export."""
    jt = derby(r, "APP.ORDERS")
    r.sync(SyncSpec("export_orders_full", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), jt)
    r.sync(SyncSpec("export_orders_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="1999-01-01"), r.parquet("orders"), jt)
    return jt


def q_jdbc_roundtrip(spark, sf_dir):
    """Export to JDBC (overwrite + incremental append, state kept apart from the target) and read back."""
    r = Run(spark, sf_dir)
    jt = _export_orders(r)
    back = r.table("orders_back")
    r.sync(SyncSpec("import_orders", write_mode="overwrite"), jt, back)
    return back.read(spark)


def q_jdbc_partitioned_read(spark, sf_dir):
    """Incremental JDBC read split into 4 partitions on o_orderkey (bounds under the same filter)."""
    r = Run(spark, sf_dir)
    jt = _export_orders(r)
    src = derby(r, "APP.ORDERS", partition_column="o_orderkey", num_partitions=4)
    target = r.table("orders_recent")
    r.sync(SyncSpec("jdbc_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="2000-01-01"), src, target)
    return target.read(spark)


def q_jdbc_equal_depth_read(spark, sf_dir):
    """A JDBC read split by a key with nine tenths of its rows in a small part of its range: each of 8 partitions holds twice the mean at most."""
    r = Run(spark, sf_dir)
    jt = derby(r, "APP.SKEWED", column_types=None)
    skewed = r.query("SELECT CASE WHEN l_orderkey % 10 < 9 THEN l_orderkey ELSE l_orderkey * 1000 END AS k, l_quantity FROM {lineitem}", "skewed")
    r.sync(SyncSpec("export_skewed", write_mode="overwrite"), skewed, jt)
    rows = derby(r, "APP.SKEWED", column_types=None, partition_column="k", num_partitions=8, split="depth").read(spark)
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.sum("k").alias("k"), F.sum("l_quantity").alias("q"))
    return parts.agg(F.sum("n").alias("n_rows"), F.sum("k").alias("sum_key"), F.sum("q").alias("sum_quantity"), F.count("*").alias("n_partitions"),
                     (F.max("n") <= 2 * F.avg("n")).alias("balanced"))


def q_jdbc_other_schema(spark, sf_dir):
    """A table of the same name in another schema is no target: 'ignore' writes the missing table, and leaves the other one alone."""
    r = Run(spark, sf_dir)
    other, own = derby(r, "OTHER.ORDERS"), derby(r, "ORDERS")
    conn = own._connect(spark)
    conn.createStatement().executeUpdate("CREATE SCHEMA OTHER")
    conn.close()
    r.sync(SyncSpec("other", write_mode="overwrite", transforms=(upto("o_orderdate", "1997-01-01"),)), r.parquet("orders"), other)
    for _ in range(2):  # the second time it is there
        r.sync(SyncSpec("own", write_mode="ignore"), r.query(CHANGED_ORDERS, "orders"), own)
    total = lambda t, name: t.read(spark).agg(F.lit(name).alias("table"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return total(own, "own").unionByName(total(other, "other"))


def q_jdbc_query_scan(spark, sf_dir):
    """A JDBC query source, partitioned as an aliased subquery and filtered by the mark."""
    r = Run(spark, sf_dir)
    _export_orders(r)
    src = derby_query(r, 'SELECT "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate" FROM APP.ORDERS '
                         "WHERE \"o_orderstatus\" = 'F'", "orders_f", partition_column="o_orderkey", num_partitions=4)
    target = r.table("orders_f")
    r.sync(SyncSpec("jdbc_query", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="1997-01-01"), src, target)
    return target.read(spark)


def q_jdbc_upsert(spark, sf_dir):
    """Merge into a JDBC table: merged result staged to Parquet, then truncate + reload."""
    r = Run(spark, sf_dir)
    jt = derby(r, "APP.ORDERS")
    r.sync(SyncSpec("jdbc_seed", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), jt)
    r.sync(SyncSpec("jdbc_merge", mode="incremental", write_mode="merge", watermark_columns=["o_orderdate"],
                    merge_keys=["o_orderkey"], initial_mark="1998-01-01"), r.query(CHANGED_ORDERS, "orders"), jt)
    back = r.table("orders_back")
    r.sync(SyncSpec("import_orders", write_mode="overwrite"), jt, back)
    return back.read(spark)


def q_jdbc_upsert_staging_table(spark, sf_dir):
    """Merge into a JDBC table through a staging table: only the batch travels, and the
    database replaces and inserts in one transaction."""
    r = Run(spark, sf_dir)
    jt = derby(r, "APP.ORDERS", upsert="staging_table")
    r.sync(SyncSpec("jdbc_seed", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), jt)
    r.sync(SyncSpec("jdbc_merge", mode="incremental", write_mode="merge", watermark_columns=["o_orderdate"],
                    merge_keys=["o_orderkey"], initial_mark="1998-01-01"), r.query(CHANGED_ORDERS, "orders"), jt)
    back = r.table("orders_back")
    r.sync(SyncSpec("import_orders", write_mode="overwrite"), jt, back)
    return back.read(spark)


def q_date_to_timestamp(spark, sf_dir):
    """DATE columns from the database arrive as timestamps (Oracle-style normalisation)."""
    r = Run(spark, sf_dir)
    jt = derby(r, "APP.ORDER_DAYS", column_types=None)
    r.sync(SyncSpec("export_days", write_mode="overwrite"),
           r.query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderday FROM {orders}", "days"), jt)
    src = derby(r, "APP.ORDER_DAYS", column_types=None, dates_as_timestamps=True)
    target = r.table("order_days")
    r.sync(SyncSpec("import_days", write_mode="overwrite"), src, target)
    return target.read(spark)


# --- transformations ---------------------------------------------------------------------

def q_transform_chain(spark, sf_dir):
    r = Run(spark, sf_dir)
    target = r.table("customers")
    chain = from_config([
        {"type": "filter", "condition": "c_acctbal > 0"},
        {"type": "select", "columns": ["c_custkey", "c_name", "c_mktsegment"]},
        {"type": "rename", "mapping": {"c_name": "customer_name"}},
    ])
    r.sync(SyncSpec("customers_clean", write_mode="overwrite", transforms=chain), r.parquet("customer"), target)
    return target.read(spark)


# --- checks ------------------------------------------------------------------------------

def q_reconcile_counts(spark, sf_dir):
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("orders_inc", mode="incremental", write_mode="append", watermark_columns=["o_orderdate"],
                    initial_mark="2000-01-01"), r.parquet("orders"), target)
    return checks.reconcile_counts(r.parquet("orders").read(spark), target.read(spark))


def q_reconcile_rows(spark, sf_dir):
    """Rows of lineitem that the key-reduced copy does not hold (EXCEPT ALL both ways)."""
    r = Run(spark, sf_dir)
    target = r.table("lineitem")
    r.sync(SyncSpec("li_latest", write_mode="merge", merge_keys=LI_KEYS, duplicate_keys="latest",
                    watermark_columns=["l_shipdate"]), r.parquet("lineitem"), target)
    return checks.reconcile_rows(r.parquet("lineitem").read(spark), target.read(spark))


def q_reconcile_keys(spark, sf_dir):
    """Keyed comparison of orders with the merged target: changed / missing per key."""
    r = Run(spark, sf_dir)
    target = r.table("orders")
    r.sync(SyncSpec("seed", write_mode="overwrite", transforms=(upto("o_orderdate", "1999-01-01"),)),
           r.parquet("orders"), target)
    r.sync(SyncSpec("orders_upsert", write_mode="merge", merge_keys=["o_orderkey"]),
           r.query(CHANGED_ORDERS + " WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1999-06-01'", "x"),
           target)
    return checks.reconcile_keys(r.parquet("orders").read(spark), target.read(spark), ["o_orderkey"])


def q_preflight_keys(spark, sf_dir):
    r = Run(spark, sf_dir)
    return checks.duplicate_keys(r.parquet("lineitem").read(spark), LI_KEYS)


def q_preflight_checks(spark, sf_dir):
    r = Run(spark, sf_dir)
    return checks.preflight(r.parquet("lineitem").read(spark), LI_KEYS, ["l_shipdate"])


SCHEMA_DIFF_SOURCE = ("SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, "
                      "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END AS o_totalprice, "
                      "o_orderdate, o_orderpriority, o_orderstatus AS o_status FROM {orders}")


def q_schema_diff(spark, sf_dir):
    """Source vs target schema, with per-column counts of values that would not convert."""
    r = Run(spark, sf_dir)
    return checks.schema_diff(r.query(SCHEMA_DIFF_SOURCE, "s").read(spark), r.parquet("orders").read(spark))


def q_stale_marks(spark, sf_dir):
    """Data freshness: each stored mark against the newest value its source holds now. One
    pipeline stopped at 01-10, one is current, a numeric mark trails, one never ran."""
    r = Run(spark, sf_dir)
    r.sync(SyncSpec("events_lagging", mode="incremental", write_mode="append", watermark_columns=["ts"]),
           r.query(EVENTS_AS_OF % "2024-01-10 00:00:00", "events"), r.table("events_a"))
    r.sync(SyncSpec("events_current", mode="incremental", write_mode="append", watermark_columns=["ts"]),
           r.parquet("events"), r.table("events_b"))
    r.sync(SyncSpec("orders_by_key", mode="incremental", write_mode="append", watermark_columns=["o_orderkey"]),
           r.query("SELECT * FROM {orders} WHERE o_orderdate < TIMESTAMP '2000-01-01'", "orders"), r.table("orders"))
    newest = checks.newest_marks({
        "events_lagging": (r.parquet("events").read(spark), ["ts"]),
        "events_current": (r.parquet("events").read(spark), ["ts"]),
        "orders_by_key": (r.parquet("orders").read(spark), ["o_orderkey"]),
        "customers_new": (r.parquet("customer").read(spark), ["c_custkey"]),
    })
    return checks.mark_lag(r.state.current(), newest, dt.timedelta(days=1), stale_after_units=1000)


STALE_MARKS_SQL = """
WITH n AS (
  SELECT 'events_lagging' AS pipeline_id, epoch_us(max(ts)) AS newest_micros, CAST(NULL AS DOUBLE) AS newest_number FROM events
  UNION ALL SELECT 'events_current', epoch_us(max(ts)), NULL FROM events
  UNION ALL SELECT 'orders_by_key', NULL, CAST(max(o_orderkey) AS DOUBLE) FROM orders
  UNION ALL SELECT 'customers_new', NULL, CAST(max(c_custkey) AS DOUBLE) FROM customer),
s AS (
  SELECT 'events_lagging' AS pipeline_id, 'timestamp_ntz' AS watermark_type, epoch_us(max(ts)) AS m_micros,
         CAST(NULL AS DOUBLE) AS m_number FROM events WHERE ts < TIMESTAMP '2024-01-10'
  UNION ALL SELECT 'events_current', 'timestamp_ntz', epoch_us(max(ts)), NULL FROM events
  UNION ALL SELECT 'orders_by_key', 'bigint', NULL, CAST(max(o_orderkey) AS DOUBLE) FROM orders
            WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT n.pipeline_id, s.watermark_type, (newest_micros - m_micros) / 1000000.0 AS lag_seconds,
       newest_number - m_number AS lag_units,
       CASE WHEN s.watermark_type IS NULL THEN (newest_micros IS NOT NULL OR newest_number IS NOT NULL)
            WHEN newest_micros IS NOT NULL THEN (newest_micros - m_micros) / 1000000.0 > 86400
            WHEN newest_number IS NOT NULL THEN newest_number - m_number > 1000
            ELSE false END AS stale
FROM n LEFT JOIN s USING (pipeline_id)
"""


class _StopBeforeState(StateStore):
    """A state store whose pipeline dies after publishing, before its state is written."""

    def put(self, *args, **kw):
        raise InterruptedError("stopped before the state update")


def q_append_crash_replay(spark, sf_dir):
    """Two pipelines append into one table. One is stopped after its publish and an idle poll has run
    before: the replay adds nothing twice, and loses nothing to the other's rows."""
    r = Run(spark, sf_dir)
    target = r.table("events")
    clicks, others = "SELECT * FROM {events} WHERE event_type = 'click'", "SELECT * FROM {events} WHERE event_type <> 'click'"
    early = " AND ts < TIMESTAMP '2024-01-16'"
    specs = [SyncSpec(n, mode="incremental", write_mode="append", watermark_columns=["ts"]) for n in ("clicks", "others")]
    r.sync(specs[0], r.query(clicks + early, "clicks"), target)
    r.sync(specs[0], r.query(clicks + early, "clicks"), target)  # idle
    r.sync(specs[1], r.query(others, "others"), target)
    try:
        sync(spark, specs[0], r.query(clicks, "clicks"), target, _StopBeforeState(spark, path=r.state.path), r.history)
    except InterruptedError:
        pass
    r.sync(specs[0], r.query(clicks, "clicks"), target)
    r.sync(specs[0], r.query(clicks, "clicks"), target)
    return target.read(spark)


def _two_batches(spark, sf_dir, columns: str, mark: str, until: str) -> DataFrame:
    """Incremental append of lineitem columns in two batches, up to a mark and then the rest."""
    r = Run(spark, sf_dir)
    target = r.table("rows")
    spec = SyncSpec("two", mode="incremental", write_mode="append", watermark_columns=[mark])
    whole = f"SELECT {columns} FROM {{lineitem}}"
    r.sync(spec, r.query(f"SELECT * FROM ({whole}) WHERE {mark} <= {until}", "rows"), target)
    r.sync(spec, r.query(whole, "rows"), target)
    return target.read(spark)


def q_incremental_filter_decimal(spark, sf_dir):
    """A decimal mark of scale 12, split between values that differ in the twelfth digit."""
    return _two_batches(spark, sf_dir, "l_orderkey, l_linenumber, CAST(1 AS DECIMAL(20,12)) + CAST(l_orderkey AS DECIMAL(20,12)) * "
                        "CAST(0.000000000001 AS DECIMAL(20,12)) AS m", "m", "1.000000000100").select(
        "l_orderkey", "l_linenumber", F.col("m").cast("decimal(38,12)").cast("string").alias("m"))


def q_incremental_filter_date(spark, sf_dir):
    """A date mark."""
    return _two_batches(spark, sf_dir, "l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS m", "m", "DATE '1997-03-04'")


def q_incremental_filter_timestamp_tz(spark, sf_dir):
    """A mark that is an instant (timestamp with the session's zone), whatever that zone is."""
    found = _two_batches(spark, sf_dir, "l_orderkey, l_linenumber, timestamp_micros(unix_micros(CAST('1995-01-01 00:00:00Z' AS TIMESTAMP)) "
                         "+ l_orderkey * 1000001) AS m", "m", "timestamp_micros(unix_micros(CAST('1995-01-01 01:00:00Z' AS TIMESTAMP)))")
    return found.select("l_orderkey", "l_linenumber", F.unix_micros("m").alias("m_micros"))


NULL_PARTITIONS = ("SELECT CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS a, CAST(user_id % 3 AS INT) AS b, event_id, value + {plus} AS value "
                   "FROM {{events}} WHERE {where}")


def q_merge_partitioned_null(spark, sf_dir):
    """Merge into a table partitioned by two columns, NULLs in one of them: rows that the batch does not
    touch stay in every partition."""
    r = Run(spark, sf_dir)
    target = r.table("parts", partition_by=("a", "b"))
    r.sync(SyncSpec("seed", write_mode="overwrite"), r.query(NULL_PARTITIONS.format(plus=0, where="ts <= TIMESTAMP '2024-01-25'"), "e"), target)
    r.sync(SyncSpec("more", write_mode="merge", merge_keys=["a", "b", "event_id"]),
           r.query(NULL_PARTITIONS.format(plus=1, where="ts > TIMESTAMP '2024-01-20' AND event_type <> 'signup'"), "e"), target)
    return target.read(spark)


def q_merge_latest_renamed(spark, sf_dir):
    """``latest`` orders by the mark although a transformation renames it."""
    r = Run(spark, sf_dir)
    target = r.table("last_event")
    r.sync(SyncSpec("last", mode="incremental", write_mode="merge", merge_keys=["user_id"], duplicate_keys="latest", watermark_columns=["ts"],
                    transforms=from_config([{"type": "rename", "mapping": {"ts": "happened"}}])), r.parquet("events"), target)
    return target.read(spark)


def q_reconcile_keys_nulls(spark, sf_dir):
    """Keyed comparison where values swap places with NULLs, and an int column stands against a bigint one."""
    r = Run(spark, sf_dir)
    rows = "SELECT o_orderkey, CAST(o_custkey AS {kind}) AS c, {x} AS x, {y} AS y FROM {{orders}}"
    swapped = "CASE WHEN o_orderstatus = 'F' THEN {} END"
    source = r.query(rows.format(kind="INT", x=swapped.format("o_orderpriority"), y="CAST(NULL AS STRING)"), "s").read(spark)
    target = r.query(rows.format(kind="BIGINT", x="CAST(NULL AS STRING)", y=swapped.format("o_orderpriority")), "t").read(spark)
    return checks.reconcile_keys(source, target, ["o_orderkey"])


def q_run_monitor_failures(spark, sf_dir):
    """Monitoring of a pipeline with a failed run, an empty run and, by a limit of no time, long runs."""
    r = Run(spark, sf_dir)
    spec = SyncSpec("mixed", mode="incremental", write_mode="append", watermark_columns=["ts"])
    target = r.table("events")
    r.sync(spec, r.parquet("events"), target)
    r.sync(spec, r.parquet("events"), target)
    try:
        r.sync(spec, r.query("SELECT event_id FROM {events}", "events"), target)
    except ValueError:
        pass
    return checks.run_monitor(r.history.runs(), long_run_seconds=0.0).drop("last_success")


def q_stale_state(spark, sf_dir):
    """Marks not updated for a week, seen eight days after the run, and none of them seen at once."""
    r = Run(spark, sf_dir)
    for name in ("orders", "customer"):
        column = {"orders": "o_orderkey", "customer": "c_custkey"}[name]
        r.sync(SyncSpec(f"{name}_keys", mode="incremental", write_mode="append", watermark_columns=[column]), r.parquet(name), r.table(name))
    week = dt.timedelta(days=7)
    later = checks.stale_marks(r.state.current(), week, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=8))
    now = checks.stale_marks(r.state.current(), week)
    shown = lambda df, when: df.select(F.lit(when).alias("seen"), "pipeline_id", "watermark_value_bigint")
    return shown(later, "later").unionByName(shown(now, "now"))


def entry(spark: SparkSession) -> DataFrame:
    return q_merge_incremental(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | (llm_queries.queries() if llm_queries else {})


def oracle_sql() -> dict[str, str]:
    return _own_oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "merge_incremental": q_merge_incremental,
        "merge_bucketed_target": q_merge_bucketed_target,
        "full_refresh": q_full_refresh,
        "full_refresh_schema_change": q_full_refresh_schema_change,
        "incremental_filter_timestamp": q_incremental_filter_timestamp,
        "incremental_filter_multi": q_incremental_filter_multi,
        "max_mark": q_max_mark,
        "incremental_filter_numeric": q_incremental_filter_numeric,
        "incremental_filter_string": q_incremental_filter_string,
        "incremental_custom_query": q_incremental_custom_query,
        "incremental_append": q_incremental_append,
        "batch_metrics": q_batch_metrics,
        "append_crash_replay": q_append_crash_replay,
        "incremental_filter_decimal": q_incremental_filter_decimal,
        "incremental_filter_date": q_incremental_filter_date,
        "incremental_filter_timestamp_tz": q_incremental_filter_timestamp_tz,
        "merge_partitioned_null": q_merge_partitioned_null,
        "merge_latest_renamed": q_merge_latest_renamed,
        "reconcile_keys_nulls": q_reconcile_keys_nulls,
        "run_monitor_failures": q_run_monitor_failures,
        "stale_state": q_stale_state,
        "run_monitor": q_run_monitor,
        "incremental_append_subsecond": q_incremental_append_subsecond,
        "merge_single_key": q_merge_single_key,
        "merge_composite_key": q_merge_composite_key,
        "merge_latest_wins": q_merge_latest_wins,
        "merge_partitioned_target": q_merge_partitioned_target,
        "merge_partitioned_composite": q_merge_partitioned_composite,
        "merge_partitioned_bucketed": q_merge_partitioned_bucketed,
        "merge_null_keys": q_merge_null_keys,
        "merge_into_missing_table": q_merge_into_missing_table,
        "merge_closed_boundary": q_merge_closed_boundary,
        "late_lookback": q_late_lookback,
        "merge_table_to_table": q_merge_table_to_table,
        "chained_sync_detail": q_chained_sync_detail,
        "state_after_sync": q_state_after_sync,
        "state_legacy_migration": q_state_legacy_migration,
        "empty_batch_noop": q_empty_batch_noop,
        "save_modes_ignore_error": q_save_modes_ignore_error,
        "jdbc_roundtrip": q_jdbc_roundtrip,
        "jdbc_partitioned_read": q_jdbc_partitioned_read,
        "jdbc_query_scan": q_jdbc_query_scan,
        "jdbc_upsert": q_jdbc_upsert,
        "jdbc_upsert_staging_table": q_jdbc_upsert_staging_table,
        "date_to_timestamp": q_date_to_timestamp,
        "transform_chain": q_transform_chain,
        "reconcile_counts": q_reconcile_counts,
        "reconcile_rows": q_reconcile_rows,
        "reconcile_keys": q_reconcile_keys,
        "preflight_keys": q_preflight_keys,
        "preflight_checks": q_preflight_checks,
        "schema_diff": q_schema_diff,
        "stale_marks": q_stale_marks,
        "late_append_once": q_late_append_once,
        "reconcile_drilldown": q_reconcile_drilldown,
        "view_schema_evolution": q_view_schema_evolution,
        "namespace_listing": q_namespace_listing,
        "preflight_hot_keys": q_preflight_hot_keys,
        "run_anomalies": q_run_anomalies,
        "merge_touched_files": q_merge_touched_files,
        "publish_view_partitions": q_publish_view_partitions,
        "state_two_writers": q_state_two_writers,
        "chain_one_cut": q_chain_one_cut,
        "jdbc_equal_depth_read": q_jdbc_equal_depth_read,
        "jdbc_other_schema": q_jdbc_other_schema,
    }


LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
           "l_returnflag, l_linestatus, l_shipdate")
LI_LATEST_ORDER = ("l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
                   "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC")
LI_PLUS_SQL = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, "
               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
ORDERS_PLUS_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, "
                   "o_orderdate, o_orderpriority FROM orders")


def li_latest(rel: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {LI_LATEST_ORDER}) AS rn FROM ({rel})) WHERE rn = 1")


def merge_sql(t: str, s: str, on: str) -> str:
    return (f"WITH t AS ({t}), s AS ({s}) SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on}) "
            f"UNION ALL SELECT * FROM s")


DAY_1998, DAY_1999 = "TIMESTAMP '1998-01-01'", "TIMESTAMP '1999-01-01'"
EVENTS_COLS = "event_id, ts, user_id, event_type, value, props"


def _own_oracle_sql() -> dict[str, str]:
    li_on = "s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber"
    two = f"SELECT * FROM ({TWO_MARKS_SQL}) WHERE created > TIMESTAMP '2000-06-01' OR modified > TIMESTAMP '2000-06-01'"
    events_batches = ["ts < TIMESTAMP '2024-01-10'",
                      "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'",
                      "ts >= TIMESTAMP '2024-01-20'"]
    return {
        "merge_incremental": MERGE_INCREMENTAL_SQL,
        "merge_bucketed_target": MERGE_INCREMENTAL_SQL,
        "full_refresh": f"SELECT {ORDERS_COLS} FROM orders",
        "full_refresh_schema_change": "SELECT o_orderkey, o_totalprice FROM orders",
        "incremental_filter_timestamp": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'",
        "incremental_filter_multi": two,
        "max_mark": (f"SELECT max(greatest(coalesce(created, modified), coalesce(modified, created))) AS max_mark, "
                     f"count(*) AS records FROM ({two})"),
        "incremental_filter_numeric": (
            f"SELECT {EVENTS_COLS} FROM events WHERE ts < TIMESTAMP '2024-01-16' UNION ALL "
            f"SELECT {EVENTS_COLS} FROM events WHERE event_id > "
            f"(SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16')"),
        "incremental_filter_string": (
            "SELECT 'customer' AS src, c_custkey AS id FROM customer WHERE c_name > 'Customer#000000999' "
            "UNION ALL SELECT 'events', event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:30:00'"),
        "incremental_custom_query": (
            "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F' "
            "AND o_orderpriority = '1-URGENT' AND o_orderdate > TIMESTAMP '1999-01-01'"),
        "incremental_append": f"SELECT {EVENTS_COLS} FROM events",
        "batch_metrics": " UNION ALL ".join(
            f"SELECT count(*) AS records_synced, max(ts) AS mark_after FROM events WHERE {w}" for w in events_batches),
        "append_crash_replay": f"SELECT {EVENTS_COLS} FROM events",
        "incremental_filter_decimal": (
            "SELECT l_orderkey, l_linenumber, CAST(CAST(1 AS DECIMAL(38,12)) + CAST(l_orderkey AS DECIMAL(20,0)) * "
            "CAST(0.000000000001 AS DECIMAL(13,12)) AS VARCHAR) AS m FROM lineitem"),
        "incremental_filter_date": "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS m FROM lineitem",
        "incremental_filter_timestamp_tz": (
            "SELECT l_orderkey, l_linenumber, epoch_us(TIMESTAMP '1995-01-01') + l_orderkey * 1000001 AS m_micros FROM lineitem"),
        "merge_partitioned_null": (
            "WITH e AS (SELECT CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS a, CAST(user_id % 3 AS INT) AS b, "
            "event_id, value, ts, event_type FROM events), "
            "s AS (SELECT a, b, event_id, value + 1 AS value FROM e WHERE ts > TIMESTAMP '2024-01-20' AND event_type <> 'signup') "
            "SELECT a, b, event_id, value + 0 AS value FROM e t WHERE ts <= TIMESTAMP '2024-01-25' AND NOT EXISTS "
            "(SELECT 1 FROM s WHERE s.a = t.a AND s.b = t.b AND s.event_id = t.event_id) UNION ALL SELECT * FROM s"),
        "merge_latest_renamed": ("SELECT event_id, ts AS happened, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
                                 "(PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1"),
        "reconcile_keys_nulls": "SELECT o_orderkey, 'changed' AS status FROM orders WHERE o_orderstatus = 'F'",
        "run_monitor_failures": ("SELECT 'mixed' AS pipeline_id, 3 AS runs, 1 AS failures, 1 AS zero_row_runs, 3 AS long_runs, "
                                 "count(*) AS rows_synced FROM events"),
        "stale_state": ("SELECT 'later' AS seen, 'orders_keys' AS pipeline_id, max(o_orderkey) AS watermark_value_bigint FROM orders "
                        "UNION ALL SELECT 'later', 'customer_keys', max(c_custkey) FROM customer"),
        "run_monitor": ("SELECT 'events_append' AS pipeline_id, 4 AS runs, 0 AS failures, 1 AS zero_row_runs, "
                        "0 AS long_runs, count(*) AS rows_synced FROM events"),
        "incremental_append_subsecond": f"SELECT {EVENTS_COLS} FROM events",
        "merge_single_key": merge_sql(f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01'",
                                      f"{ORDERS_PLUS_SQL} WHERE o_orderdate > TIMESTAMP '1998-01-01'",
                                      "s.o_orderkey = t.o_orderkey"),
        "merge_composite_key": merge_sql(
            li_latest(f"SELECT {LI_COLS} FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-01-01'"),
            li_latest(f"{LI_PLUS_SQL} WHERE l_shipdate > TIMESTAMP '1998-01-01'"), li_on),
        "merge_latest_wins": (f"SELECT {EVENTS_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
                              f"ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1"),
        "merge_partitioned_target": merge_sql(
            f"SELECT {EVENTS_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn "
            f"FROM events WHERE ts <= TIMESTAMP '2024-01-15') WHERE rn = 1",
            f"SELECT {EVENTS_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn "
            f"FROM events WHERE ts > TIMESTAMP '2024-01-15' AND event_type <> 'signup') WHERE rn = 1",
            "s.event_type = t.event_type"),
        "merge_partitioned_composite": merge_sql(
            f"SELECT {EVENTS_COLS} FROM events WHERE ts <= TIMESTAMP '2024-01-25'",
            "SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM events "
            "WHERE ts > TIMESTAMP '2024-01-20' AND event_type <> 'signup'",
            "s.event_type = t.event_type AND s.event_id = t.event_id"),
        "merge_partitioned_bucketed": merge_sql(
            f"SELECT {EVENTS_COLS} FROM events WHERE ts <= TIMESTAMP '2024-01-25'",
            "SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM events "
            "WHERE ts > TIMESTAMP '2024-01-20' AND event_type <> 'signup'",
            "s.event_type = t.event_type AND s.event_id = t.event_id"),
        "merge_null_keys": merge_sql(
            "SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_custkey END AS k, c_name, c_nationkey, "
            "c_acctbal, c_mktsegment FROM customer WHERE c_nationkey < 13",
            "SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_custkey END AS k, c_name, c_nationkey, "
            "c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer", "s.k = t.k"),
        "merge_into_missing_table": f"SELECT {LI_COLS} FROM lineitem",
        "merge_closed_boundary": f"SELECT {ORDERS_COLS} FROM orders",
        "late_lookback": f"SELECT {EVENTS_COLS} FROM events",
        "merge_table_to_table": merge_sql(
            f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate <= TIMESTAMP '2000-06-01'",
            f"{ORDERS_PLUS_SQL} WHERE o_orderdate > TIMESTAMP '2000-01-01'", "s.o_orderkey = t.o_orderkey"),
        "chained_sync_detail": merge_sql(
            li_latest(f"SELECT {LI_COLS} FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-06-01'"),
            li_latest(f"{LI_PLUS_SQL} WHERE l_shipdate > TIMESTAMP '2000-01-01'"), li_on),
        "state_after_sync": (
            "SELECT 'orders_append' AS pipeline_id, 'testdata' AS source_connection, '' AS source_schema, "
            "'orders' AS source_table, 'o_orderdate' AS watermark_column, 'timestamp_ntz' AS watermark_type, "
            "max(o_orderdate) AS watermark_value_timestamp_ntz, CAST(NULL AS BIGINT) AS watermark_value_bigint, "
            "CAST(NULL AS INT) AS watermark_value_int, count(*) AS last_record_count FROM orders "
            "UNION ALL SELECT 'events_by_id', 'testdata', '', 'events', 'event_id', 'bigint', NULL, max(event_id), "
            "NULL, count(*) FILTER (WHERE event_id > (SELECT max(event_id) FROM events "
            "WHERE ts < TIMESTAMP '2024-01-16')) FROM events "
            "UNION ALL SELECT 'customers_by_key', 'testdata', '', 'customer', 'c_nationkey', 'int', NULL, NULL, "
            "max(c_nationkey), count(*) FROM customer"),
        "state_legacy_migration": (
            "SELECT 'legacy_' || event_type AS pipeline_id, 'oracle_legacy' AS source_connection, "
            "'events_db' AS source_schema, event_type AS source_table, 'bigint' AS watermark_type, "
            "max(event_id) AS watermark_value_bigint, CAST(NULL AS VARCHAR) AS watermark_value_string, "
            "CAST(NULL AS BIGINT) AS last_record_count FROM events WHERE event_type <> 'click' "
            "AND ts < TIMESTAMP '2024-01-16' GROUP BY event_type "
            "UNION ALL SELECT 'legacy_user_' || CAST(user_id AS VARCHAR), 'oracle_legacy', 'users_db', "
            "'user_' || CAST(user_id AS VARCHAR), 'string', NULL, max(props), NULL FROM events GROUP BY user_id "
            "UNION ALL SELECT 'legacy_click', 'oracle_legacy', 'events_db', 'click', 'bigint', "
            "max(event_id), NULL, count(*) FILTER (WHERE event_id > (SELECT max(event_id) FROM events "
            "WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-16')) FROM events WHERE event_type = 'click'"),
        "empty_batch_noop": f"SELECT {ORDERS_COLS} FROM orders",
        "save_modes_ignore_error": f"SELECT {ORDERS_COLS} FROM orders",
        "jdbc_roundtrip": f"SELECT {ORDERS_COLS} FROM orders",
        "jdbc_partitioned_read": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'",
        "jdbc_query_scan": ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders "
                            "WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1997-01-01'"),
        "jdbc_upsert": MERGE_INCREMENTAL_SQL,
        "jdbc_upsert_staging_table": MERGE_INCREMENTAL_SQL,
        "date_to_timestamp": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderday FROM orders",
        "transform_chain": ("SELECT c_custkey, c_name AS customer_name, c_mktsegment FROM customer "
                            "WHERE c_acctbal > 0"),
        "reconcile_counts": ("SELECT (SELECT count(*) FROM orders) AS source_count, "
                             "(SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01') AS target_count, "
                             "(SELECT count(*) FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01') AS difference"),
        "reconcile_rows": (f"WITH t AS ({li_latest('SELECT * FROM lineitem')}), "
                           f"u AS (SELECT {LI_COLS}, 1 AS s FROM lineitem UNION ALL SELECT {LI_COLS}, 0 FROM t) "
                           f"SELECT {LI_COLS}, CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(1 - s) AS BIGINT) AS target_rows FROM u "
                           f"GROUP BY ALL HAVING sum(s) <> sum(1 - s)"),
        "reconcile_keys": (
            "SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1999-06-01' THEN 'missing_in_target' "
            "ELSE 'changed' END AS status FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'"),
        "preflight_keys": ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                           "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
        "preflight_checks": (
            "SELECT 'unique_keys' AS \"check\", 'l_orderkey,l_linenumber' AS subject, CAST(coalesce(sum(n), 0) AS BIGINT) AS violations "
            "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) "
            "UNION ALL SELECT 'non_null_key', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem "
            "UNION ALL SELECT 'non_null_key', 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem "
            "UNION ALL SELECT 'non_null_mark', 'l_shipdate', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem"),
        "schema_diff": (
            "SELECT 'o_orderkey' AS \"column\", 'bigint' AS source_type, 'bigint' AS target_type, 'same' AS status, "
            "0 AS unconvertible UNION ALL SELECT 'o_custkey', 'int', 'bigint', 'type_differs', 0 "
            "UNION ALL SELECT 'o_totalprice', 'string', 'double', 'type_differs', "
            "(SELECT count(*) FROM orders WHERE o_orderstatus = 'P') "
            "UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same', 0 "
            "UNION ALL SELECT 'o_orderpriority', 'string', 'string', 'same', 0 "
            "UNION ALL SELECT 'o_status', 'string', NULL, 'only_in_source', 0 "
            "UNION ALL SELECT 'o_orderstatus', NULL, 'string', 'only_in_target', 0"),
        "stale_marks": STALE_MARKS_SQL,
        "late_append_once": f"SELECT {EVENTS_COLS} FROM events",
        "reconcile_drilldown": ("SELECT o_orderkey, CASE o_orderkey % 1000 WHEN 7 THEN 'missing_in_target' ELSE 'changed' END AS status FROM orders "
                                "WHERE o_orderkey % 1000 = 7 OR o_orderkey % 1000 = 13 AND o_totalprice <> 0"),
        "view_schema_evolution": (
            "SELECT p_partkey, CAST(CASE WHEN p_partkey % 10 = 0 THEN p_size + 1 ELSE p_size END AS BIGINT) AS p_size, p_partkey AS mark, "
            "CASE WHEN p_partkey BETWEEN 501 AND 1500 AND p_partkey % 10 <> 0 THEN p_brand END AS p_brand, "
            "CASE WHEN p_partkey % 10 = 0 THEN p_retailprice END AS p_retailprice FROM part WHERE p_partkey <= 1500 OR p_partkey % 10 = 0"),
        "namespace_listing": ("SELECT lower(replace(r_name, ' ', '_')) AS namespace, CAST(1 AS BIGINT) AS tables, count(n_nationkey) AS nations "
                              "FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name"),
        "preflight_hot_keys": (
            "SELECT 'user_id' AS key, CAST(user_id AS VARCHAR) AS value, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 0.005 * (SELECT count(*) FROM events) "
            "UNION ALL SELECT 'event_type,user_id', event_type || ',' || user_id, count(*) FROM events GROUP BY event_type, user_id "
            "HAVING count(*) >= 0.0015 * (SELECT count(*) FROM events)"),
        "run_anomalies": (
            "WITH r AS (SELECT 'user_' || user_id AS pipeline_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS started_at, count(*) AS n, max(value) AS s, "
            "count(*) FILTER (event_type = 'error') >= 2 AS failed FROM events GROUP BY ALL), "
            "w AS (SELECT *, count(*) OVER b AS before, quantile_cont(s, 0.5) OVER b AS ms, quantile_cont(n, 0.5) OVER b AS mn FROM r WHERE NOT failed "
            "WINDOW b AS (PARTITION BY pipeline_id ORDER BY started_at ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)), "
            "l AS (SELECT *, lag(failed) OVER (PARTITION BY pipeline_id ORDER BY started_at) AS last FROM r) "
            "SELECT pipeline_id, started_at, 'slow' AS problem, s AS value, ms AS usual, before FROM w WHERE before >= 3 AND s > 2 * ms "
            "UNION ALL SELECT pipeline_id, started_at, 'many_rows', n, mn, before FROM w WHERE before >= 3 AND n > 2 * mn "
            "UNION ALL SELECT pipeline_id, started_at, 'few_rows', n, mn, before FROM w WHERE before >= 3 AND n * 2 < mn "
            "UNION ALL SELECT pipeline_id, started_at, 'failed', NULL, NULL, 0 FROM l WHERE failed AND NOT coalesce(last, false)"),
        "merge_touched_files": (
            f"WITH two AS ({merge_sql(li_latest(f'SELECT {LI_COLS} FROM lineitem WHERE l_shipdate <= ' + DAY_1999), li_latest(f'{LI_PLUS_SQL} WHERE l_shipdate > ' + DAY_1998), li_on)}), "
            f"few AS ({li_latest(f'{LI_PLUS_SQL} WHERE l_orderkey <= (SELECT max(l_orderkey) FROM lineitem) / 100')}) "
            "SELECT * FROM two t WHERE NOT EXISTS (SELECT 1 FROM few s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber) "
            "UNION ALL SELECT * FROM few"),
        "publish_view_partitions": "SELECT event_id, user_id, value, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
        "state_two_writers": (
            "SELECT 'rows' AS what, count(*) AS n FROM events UNION ALL SELECT 'of_the_late_run', 0 UNION ALL SELECT 'failed_runs', 1 "
            "UNION ALL SELECT 'revision', 1 UNION ALL SELECT 'records', count(*) FROM events UNION ALL SELECT 'mark', epoch_us(max(ts)) FROM events"),
        "chain_one_cut": (
            "WITH m AS (SELECT quantile_cont(epoch_us(o_orderdate), 0.5) AS m FROM orders), "
            "d AS (SELECT l_quantity, epoch_us(o_orderdate) <= (SELECT m FROM m) AS early FROM lineitem JOIN orders ON o_orderkey = l_orderkey) "
            "SELECT 'orphans' AS what, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'first_run', count(*) FILTER (early) FROM d UNION ALL SELECT 'lines', count(*) FROM d "
            "UNION ALL SELECT 'quantity', CAST(sum(l_quantity) AS BIGINT) FROM d UNION ALL SELECT 'orders', count(*) FROM orders"),
        "jdbc_equal_depth_read": (
            "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN l_orderkey % 10 < 9 THEN l_orderkey ELSE l_orderkey * 1000 END) AS BIGINT) AS sum_key, "
            "sum(l_quantity) AS sum_quantity, 8 AS n_partitions, true AS balanced FROM lineitem"),
        "jdbc_other_schema": (
            "SELECT 'own' AS \"table\", count(*) AS n, round(sum(o_totalprice + 1), 2) AS total FROM orders "
            "UNION ALL SELECT 'other', count(*), round(sum(o_totalprice), 2) FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-01'"),
    }
