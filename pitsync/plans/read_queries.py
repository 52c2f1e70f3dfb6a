"""Queries on the read side: scans, filters, projections, snapshots, deduplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.functions.ordering import By
from pitsync.operators.audit import new_mark
from pitsync.operators.dedupe import (
    duplicate_keys,
    duplicate_report,
    keep_last,
    latest_n_per_key,
    latest_per_key,
)
from pitsync.operators.filters import apply_filters, semi_filter, since
from pitsync.operators.project import add_missing_keys, align_to, derive, normalise, stamp, unpack_json
from pitsync.operators.snapshots import distinct_points, month_ends, snapshot_asof, snapshot_valid
from pitsync.plans.carry import CarriedAsof
from pitsync.plans.extract import plan_extract
from pitsync.plans.registry import Tables, query
from pitsync.session import work_dir
from pitsync.sources.scan import ordered, read_source
from pitsync.sources.sinks import SnapshotTable
from pitsync.spec import Members, Snapshot, TableSpec, Unpack

NEWEST_ORDER = [By("o_orderdate"), By("o_orderkey")]
LINE_KEYS = ["l_orderkey", "l_linenumber"]
#: every other column, as a total order for lines that repeat a key
LINE_TIES = [
    By("l_partkey"),
    By("l_suppkey"),
    By("l_quantity"),
    By("l_extendedprice"),
    By("l_discount"),
    By("l_tax"),
    By("l_returnflag"),
    By("l_linestatus"),
]
LINE_TIES_SQL = (
    "l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST, l_quantity DESC NULLS FIRST, "
    "l_extendedprice DESC NULLS FIRST, l_discount DESC NULLS FIRST, l_tax DESC NULLS FIRST, "
    "l_returnflag DESC NULLS FIRST, l_linestatus DESC NULLS FIRST"
)
MEMBERS = Members("customer_building", "c_custkey", "o_custkey")


@query("table_scan", "SELECT * FROM orders")
def table_scan(t: Tables) -> DataFrame:
    return read_source(t.spark, TableSpec("orders", "orders"), {"orders": t.orders})


@query(
    "source_query_scan",
    """
    SELECT * FROM (
        SELECT o_custkey, o_orderkey, last_day(o_orderdate) AS month_end, o_totalprice FROM orders
    ) AS _src WHERE o_totalprice > 100000
    """,
)
def source_query_scan(t: Tables) -> DataFrame:
    spec = TableSpec(
        "orders",
        "orders",
        source_query="SELECT o_custkey, o_orderkey, last_day(o_orderdate) AS month_end, o_totalprice FROM {table}",
        filters=("o_totalprice > 100000",),
    )
    return plan_extract(t.spark, spec, {"orders": t.orders})


@query("ordered_scan", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey")
def ordered_scan(t: Tables) -> DataFrame:
    order = [By("o_orderdate", False), By("o_orderkey", False)]
    return ordered(t.orders, order)


@query(
    "filter_composition",
    "SELECT * FROM orders WHERE (o_orderstatus = 'F') AND (o_totalprice > 50000)",
)
def filter_composition(t: Tables) -> DataFrame:
    return apply_filters(t.orders, ["WHERE o_orderstatus = 'F'", "", "o_totalprice > 50000"])


@query(
    "filter_alternatives",
    """
    SELECT * FROM orders
    WHERE (o_orderstatus = 'F' AND o_totalprice > 200000) OR (o_orderpriority = '1-URGENT' AND o_totalprice > 100000)
    """,
)
def filter_alternatives(t: Tables) -> DataFrame:
    items = [
        "o_orderstatus = 'F'",
        "AND o_totalprice > 200000",
        "OR o_orderpriority = '1-URGENT'",
        F.col("o_totalprice") > 100000,
    ]
    return apply_filters(t.orders, items)


@query(
    "membership_filter",
    "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def membership_filter(t: Tables) -> DataFrame:
    return semi_filter(t.orders, t.customer.where("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey")


@query(
    "membership_repeated",
    "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)",
)
def membership_repeated(t: Tables) -> DataFrame:
    return semi_filter(t.customer, t.orders.where("o_totalprice > 150000"), "c_custkey", "o_custkey")


@query("high_water_mark", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def high_water_mark(t: Tables) -> DataFrame:
    return since(t.events, "ts", "2024-01-15 12:00:00")


@query(
    "run_mode_gate",
    """
    SELECT 'stored_mark' AS run_mode, event_type, count(*) AS row_count FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') GROUP BY event_type
    UNION ALL
    SELECT 'no_mark', event_type, count(*) FROM events GROUP BY event_type
    UNION ALL
    SELECT 'full_reload', event_type, count(*) FROM events GROUP BY event_type
    """,
)
def run_mode_gate(t: Tables) -> DataFrame:
    mark = t.events.where("ts < timestamp_ntz'2024-01-20'").agg(F.max("ts").alias("mark"))
    none = mark.where("mark IS NULL")
    out = None
    for mode, frame in (
        ("stored_mark", since(t.events, "ts", mark)),
        ("no_mark", since(t.events, "ts", none)),
        ("full_reload", since(t.events, "ts", mark, full_reload=True)),
    ):
        part = frame.groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))
        part = part.select(F.lit(mode).alias("run_mode"), "event_type", "row_count")
        out = part if out is None else out.unionByName(part)
    return out


@query("derived_key", "SELECT *, last_day(o_orderdate) AS month_end FROM orders")
def derived_key(t: Tables) -> DataFrame:
    return derive(t.orders, {"month_end": "last_day(o_orderdate)"})


@query(
    "json_unpack",
    """
    SELECT CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long,
           json_extract_string(props, '$.k') AS k_text,
           json_extract_string(props, '$.K') AS wrong_case,
           json_extract_string(props, '$.missing') AS missing,
           event_id, ts, user_id, event_type, value
    FROM events
    """,
)
def json_unpack(t: Tables) -> DataFrame:
    fields = [
        ("$.k", "k_double", "double"),
        ("$.k", "k_long", "bigint"),
        ("$.k", "k_text", "string"),
        ("K", "wrong_case", "string"),
        ("missing", "missing", "string"),
    ]
    return unpack_json(t.events, "props", fields, keep=["event_id", "ts", "user_id", "event_type", "value"])


@query(
    "json_latest",
    """
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, event_id, ts FROM events
    QUALIFY row_number() OVER (
        PARTITION BY CAST(json_extract_string(props, '$.k') AS BIGINT), event_type
        ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
    """,
)
def json_latest(t: Tables) -> DataFrame:
    spec = TableSpec(
        "payloads",
        "events",
        sync_mode="upsert",
        merge_keys=("k", "event_type"),
        order_by="ts",
        ties=("event_id",),
        unpack=Unpack("props", {"k": ("k", "bigint")}, ("event_type", "event_id", "ts")),
    )
    return plan_extract(t.spark, spec, {"events": t.events})


@query("distinct_spine", "SELECT DISTINCT last_day(o_orderdate) AS month_end FROM orders WHERE o_orderdate IS NOT NULL")
def distinct_spine(t: Tables) -> DataFrame:
    return month_ends(t.orders, "o_orderdate")


@query(
    "normalised_names",
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, CASE WHEN p_size <> 1 THEN p_retailprice END AS p_retailprice
    FROM part
    """,
)
def normalised_names(t: Tables) -> DataFrame:
    raw = t.part.withColumn("p_retailprice", F.when(F.col("p_size") == 1, F.lit(float("nan"))).otherwise(F.col("p_retailprice")))
    return normalise(raw.toDF(*[c.upper() for c in raw.columns]))


@query("load_stamp", "SELECT *, TIMESTAMP '2024-02-01 06:00:00' AS data_inserted_at FROM customer")
def load_stamp(t: Tables) -> DataFrame:
    return stamp(t.customer, "2024-02-01 06:00:00")


@query("missing_keys", "SELECT *, CAST(NULL AS VARCHAR) AS month_key FROM supplier")
def missing_keys(t: Tables) -> DataFrame:
    return add_missing_keys(t.supplier, ["S_SUPPKEY", "month_key"])


@query(
    "align_to_target",
    """
    SELECT c_custkey AS party_key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation_key, c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
    """,
)
def align_to_target(t: Tables) -> DataFrame:
    target = t.customer.select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("long").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
    )
    incoming = t.supplier.select(
        F.col("s_acctbal").alias("not_in_target"),
        F.col("s_nationkey").alias("NATION_KEY"),
        F.col("s_name").alias("Name"),
        F.col("s_suppkey").alias("party_key"),
    )
    return target.unionByName(align_to(incoming, target.schema))


ASOF_SQL = """
    WITH month_ends AS (SELECT DISTINCT last_day(o_orderdate) AS month_end FROM orders)
    SELECT src.*, m.month_end
    FROM {source} src JOIN month_ends m ON src.o_orderdate <= m.month_end
    QUALIFY row_number() OVER (
        PARTITION BY src.o_custkey, m.month_end
        ORDER BY src.o_orderdate DESC NULLS FIRST, src.o_orderkey DESC NULLS FIRST) = 1
"""


@query("asof_snapshot", ASOF_SQL.format(source="orders"))
def asof_snapshot(t: Tables) -> DataFrame:
    spine = month_ends(t.orders, "o_orderdate")
    return snapshot_asof(t.orders, spine, ["o_custkey"], "o_orderdate", ties=[By("o_orderkey")])


@query("asof_carried", ASOF_SQL.format(source="orders"))
def asof_carried(t: Tables) -> DataFrame:
    """The same snapshot from three increments, each joined with the state of the one before."""
    root, spine = work_dir(t.spark, "carried"), month_ends(t.orders, "o_orderdate")
    carried = CarriedAsof(SnapshotTable(t.spark, f"{root}/state"), ["o_custkey"], "o_orderdate", ties=[By("o_orderkey")], late="reject")
    steps = ("0001-01-01", "1996-12-31", "1999-06-30", "9999-12-31")
    for n in range(1, len(steps)):
        part = [F.col(c) > F.lit(steps[n - 1]).cast(k) for c, k in (("o_orderdate", "timestamp_ntz"), ("month_end", "date"))]
        upto = [F.col(c) <= F.lit(steps[n]).cast(k) for c, k in (("o_orderdate", "timestamp_ntz"), ("month_end", "date"))]
        snapshot, commit = carried.advance(t.orders.where(part[0] & upto[0]), spine.where(part[1] & upto[1]), f"r{n}", datetime(2024, 2, n))
        snapshot.write.mode("append").parquet(f"{root}/snapshots")
        commit()
    return t.spark.read.parquet(f"{root}/snapshots")


def _asof_spec(**changes: object) -> TableSpec:
    spec = TableSpec(
        "order_status",
        "orders",
        sync_mode="upsert",
        merge_keys=("o_custkey", "month_end"),
        watermark="o_orderdate",
        order_by="o_orderkey",
        members=MEMBERS,
        snapshot=Snapshot("asof", "month_spine", "month_end", ("o_custkey",), "month_end", date="o_orderdate", ties=("o_orderkey",)),
    )
    return spec.with_(**changes)


def _asof_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "orders": t.orders,
        "customer_building": t.customer.where("c_mktsegment = 'BUILDING'"),
        "month_spine": month_ends(t.orders, "o_orderdate"),
    }


BUILDING = "c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


@query(
    "asof_members",
    f"SELECT * FROM ({ASOF_SQL.format(source='orders')}) AS _src WHERE o_custkey IN (SELECT {BUILDING})",
)
def asof_members(t: Tables) -> DataFrame:
    """The flagship: latest order per BUILDING customer at every month end."""
    return plan_extract(t.spark, _asof_spec(), _asof_tables(t))


@query(
    "asof_increment",
    f"""
    SELECT * FROM ({ASOF_SQL.format(source='orders')}) AS _src
    WHERE o_custkey IN (SELECT {BUILDING}) AND o_orderdate > TIMESTAMP '2001-06-30'
    """,
)
def asof_increment(t: Tables) -> DataFrame:
    """An increment above a mark; old versions due at new month ends are not in it."""
    return plan_extract(t.spark, _asof_spec(), _asof_tables(t), mark="2001-06-30")


@query(
    "asof_increment_new_points",
    f"""
    SELECT * FROM ({ASOF_SQL.format(source='orders')}) AS _src
    WHERE o_custkey IN (SELECT {BUILDING})
      AND (o_orderdate > TIMESTAMP '2001-06-30' OR month_end > DATE '2001-06-30')
    """,
)
def asof_increment_new_points(t: Tables) -> DataFrame:
    """The same increment plus everything due at month ends after the last delivered one."""
    return plan_extract(t.spark, _asof_spec(), _asof_tables(t), mark="2001-06-30", point_mark="2001-06-30")


VALID_SQL = """
    WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    versions AS (SELECT event_id, user_id, event_type, ts AS valid_from, {end} AS valid_to FROM events)
    SELECT src.*, d.day
    FROM versions src JOIN days d ON src.valid_from < d.day AND d.day <= src.valid_to
    QUALIFY row_number() OVER (
        PARTITION BY src.user_id, d.day
        ORDER BY src.valid_from DESC NULLS FIRST, src.valid_to DESC NULLS FIRST, src.event_id DESC NULLS FIRST) = 1
"""


def _versions(t: Tables, end: str) -> DataFrame:
    return t.events.selectExpr("event_id", "user_id", "event_type", "ts AS valid_from", f"{end} AS valid_to")


@query("valid_snapshot", VALID_SQL.format(end="ts + INTERVAL 3 DAY"))
def valid_snapshot(t: Tables) -> DataFrame:
    days = distinct_points(t.events, "ts", "day")
    versions = _versions(t, "ts + INTERVAL 3 DAY")
    return snapshot_valid(versions, days, ["user_id"], "valid_from", "valid_to", ties=[By("event_id")])


@query("valid_snapshot_dyadic", VALID_SQL.format(end="ts + INTERVAL 40 DAY"))
def valid_snapshot_dyadic(t: Tables) -> DataFrame:
    """Long intervals, each cut along a binary tree of the days."""
    days = distinct_points(t.events, "ts", "day")
    versions = _versions(t, "ts + INTERVAL 40 DAY")
    return snapshot_valid(versions, days, ["user_id"], "valid_from", "valid_to", ties=[By("event_id")], overlapping="dyadic")


@query(
    "valid_snapshot_open_end",
    """
    WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    versions AS (
        SELECT event_id, user_id, event_type, ts AS valid_from,
               CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 1 DAY END AS valid_to
        FROM events)
    SELECT src.*, d.day
    FROM versions src JOIN days d ON src.valid_from < d.day AND (src.valid_to IS NULL OR d.day <= src.valid_to)
    QUALIFY row_number() OVER (
        PARTITION BY src.user_id, d.day
        ORDER BY src.valid_from DESC NULLS FIRST, src.valid_to DESC NULLS FIRST, src.event_id DESC NULLS FIRST) = 1
    """,
)
def valid_snapshot_open_end(t: Tables) -> DataFrame:
    days = distinct_points(t.events, "ts", "day")
    versions = _versions(t, "CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 1 DAY END")
    return snapshot_valid(
        versions, days, ["user_id"], "valid_from", "valid_to", ties=[By("event_id")], open_end=True
    )


@query(
    "valid_members_increment",
    f"""
    SELECT * FROM ({VALID_SQL.format(end="ts + INTERVAL 3 DAY")}) AS _src
    WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') AND valid_from > TIMESTAMP '2024-01-20 10:00:00'
    """,
)
def valid_members_increment(t: Tables) -> DataFrame:
    """Validity intervals of users who signed up, above a mark."""
    spec = TableSpec(
        "activity",
        "versions",
        sync_mode="upsert",
        merge_keys=("user_id", "day"),
        watermark="valid_from",
        members=Members("signups", "user_id", "user_id"),
        snapshot=Snapshot("valid", "days", "day", ("user_id",), "day", start="valid_from", end="valid_to", ties=("event_id",)),
    )
    tables = {
        "versions": _versions(t, "ts + INTERVAL 3 DAY"),
        "signups": t.events.where("event_type = 'signup'"),
        "days": distinct_points(t.events, "ts", "day"),
    }
    return plan_extract(t.spark, spec, tables, mark="2024-01-20 10:00:00")


@query(
    "plain_extract",
    """
    SELECT * FROM events WHERE event_type <> 'error' AND ts > TIMESTAMP '2024-01-05'
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
    """,
)
def plain_extract(t: Tables) -> DataFrame:
    """A table without a source query: filter, mark, then the latest row per merge key."""
    spec = TableSpec(
        "events", "events", sync_mode="upsert", merge_keys=("user_id", "event_type"), watermark="ts",
        order_by="ts", ties=("event_id",), filters=("event_type <> 'error'",),
    )
    return plan_extract(t.spark, spec, {"events": t.events}, mark="2024-01-05")


@query(
    "aliased_extract",
    f"""
    SELECT *, last_day(o_orderdate) AS month_end FROM orders
    WHERE o_custkey IN (SELECT {BUILDING}) AND o_orderdate > TIMESTAMP '1997-02-10'
    QUALIFY row_number() OVER (PARTITION BY o_custkey, last_day(o_orderdate) ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1
    """,
)
def aliased_extract(t: Tables) -> DataFrame:
    """A table whose month key is derived from its own date column."""
    spec = TableSpec(
        "orders", "orders", sync_mode="upsert", merge_keys=("o_custkey", "month_end"), watermark="o_orderdate",
        order_by="o_orderdate", ties=("o_orderkey",), members=MEMBERS, derive={"month_end": "last_day(o_orderdate)"},
    )
    return plan_extract(t.spark, spec, _asof_tables(t), mark="1997-02-10")


LATEST = "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1"


@query("latest_per_key", f"SELECT * FROM orders {LATEST}")
def latest_order_per_customer(t: Tables) -> DataFrame:
    return latest_per_key(t.orders, ["o_custkey"], NEWEST_ORDER, ties=[])


def _phase(t: Tables, phase: str) -> DataFrame:
    spec = TableSpec(
        "orders",
        "orders",
        sync_mode="upsert",
        merge_keys=("o_custkey",),
        order_by="o_orderdate",
        ties=("o_orderkey",),
        filters=("o_totalprice > 200000",),
        watermark="o_orderdate",
    )
    return plan_extract(t.spark, spec, {"orders": t.orders}, mark="1996-01-01", phase=phase)


@query(
    "filter_then_dedup",
    f"SELECT * FROM orders WHERE o_totalprice > 200000 AND o_orderdate > TIMESTAMP '1996-01-01' {LATEST}",
)
def filter_then_dedup(t: Tables) -> DataFrame:
    return _phase(t, "filter_then_dedup")


@query(
    "dedup_then_filter",
    f"SELECT * FROM (SELECT * FROM orders {LATEST}) WHERE o_totalprice > 200000 AND o_orderdate > TIMESTAMP '1996-01-01'",
)
def dedup_then_filter(t: Tables) -> DataFrame:
    return _phase(t, "dedup_then_filter")


@query(
    "keep_last_batch",
    f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, {LINE_TIES_SQL}) = 1
    """,
)
def keep_last_batch(t: Tables) -> DataFrame:
    return keep_last(t.lineitem, LINE_KEYS, "l_shipdate", ties=LINE_TIES)


@query(
    "target_dedup",
    f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_TIES_SQL}, l_shipdate DESC NULLS FIRST) = 1
    """,
)
def target_dedup(t: Tables) -> DataFrame:
    return latest_per_key(t.lineitem, LINE_KEYS, LINE_TIES, ties=[By("l_shipdate")])


@query(
    "duplicate_report",
    """
    SELECT count(*) AS key_count, count(*) FILTER (n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    """,
)
def duplicates_of_lines(t: Tables) -> DataFrame:
    return duplicate_report(t.lineitem, LINE_KEYS)


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count, count(*) - 1 AS surplus
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """,
)
def repeated_line_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, LINE_KEYS)


@query(
    "rolling_history",
    """
    SELECT *, CAST(row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS FIRST) AS INTEGER) AS position
    FROM events QUALIFY position <= 10
    """,
)
def rolling_history(t: Tables) -> DataFrame:
    order = [By("ts", nulls_first=False)]
    return latest_n_per_key(t.events, ["user_id"], order, 10, [By("event_id")], rank_column="position")


@query(
    "filtered_count",
    """
    SELECT count(*) AS row_count FROM (
        SELECT o_custkey, o_totalprice, last_day(o_orderdate) AS month_end FROM orders
    ) WHERE o_totalprice > 100000 AND month_end > DATE '1998-06-30'
    """,
)
def filtered_count(t: Tables) -> DataFrame:
    spec = TableSpec(
        "orders",
        "orders",
        source_query="SELECT o_custkey, o_totalprice, last_day(o_orderdate) AS month_end FROM {table}",
        filters=("o_totalprice > 100000", "month_end > DATE'1998-06-30'"),
    )
    return plan_extract(t.spark, spec, {"orders": t.orders}).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "new_mark",
    """
    SELECT event_type, coalesce(max(ts) FILTER (event_type <> 'signup'), TIMESTAMP '2024-03-01') AS mark,
           count(*) AS rows_exported
    FROM events GROUP BY event_type
    """,
)
def marks_per_type(t: Tables) -> DataFrame:
    marked = t.events.withColumn("ts", F.when(F.col("event_type") != "signup", F.col("ts")))
    return new_mark(marked, "ts", ["event_type"], "2024-03-01")
