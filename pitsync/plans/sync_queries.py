"""Queries on the write side: merges, files, streams, change detection, sealing."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.functions.hashing import chunk_file_id, keyed_id, manifest_id, metadata_file_id, table_folder_id
from pitsync.functions.ordering import By
from pitsync.functions.secrets import derive_key, open_files, open_rows, seal_files, seal_rows, secret_column
from pitsync.operators.audit import delivery_listing, size_estimate
from pitsync.operators.changes import (
    change_statistics,
    diff_hashes,
    diff_rows,
    hash_groups,
    hash_rows,
    id_collisions,
    look_up,
    rows_to_write,
)
from pitsync.operators.dedupe import key_violations
from pitsync.operators.merge import BUCKET, append, full_load, upsert, upsert_chunks
from pitsync.plans.delivery import import_listing
from pitsync.plans.registry import Tables, query
from pitsync.plans.sync import Workspace, apply_batch, export_ranges, export_table, import_ranges, import_table
from pitsync.session import work_dir
from pitsync.sources.layouts import compare_layouts, files_reached, standard_layouts
from pitsync.sources.manifest import file_listing, manifest, manifest_totals, rows_per_file, verify
from pitsync.sources.sinks import LayoutSpec, PartitionedTable, SnapshotTable, overwrite_partitions, write_layout
from pitsync.sources.state import current_marks, mark_history, pending_files
from pitsync.spec import TableSpec
from pitsync.streaming.ingest import bucketed_batch, file_stream, ingest_available, upsert_stream

SALT = "bench-salt"
RUN_TS = datetime(2024, 2, 1, 6, 0, 0)


# ---- applying batches -------------------------------------------------------------------


@query("full_reload", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def full_reload(t: Tables) -> DataFrame:
    return full_load(t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'"), t.orders)


@query("incremental_append", "SELECT * FROM orders")
def incremental_append(t: Tables) -> DataFrame:
    cut = "timestamp_ntz'1998-01-01'"
    return append(t.orders.where(f"o_orderdate < {cut}"), t.orders.where(f"o_orderdate >= {cut}"))


def _order_batch(t: Tables) -> DataFrame:
    """Line totals per order: some columns of the target, one new one, keys of all orders."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("o_totalprice"),
        # counters instead of max(text), which Spark can only do by sorting
        F.when(F.count_if(F.col("l_returnflag") == "R") > 0, F.lit("R"))
        .when(F.count_if(F.col("l_returnflag") == "A") > 0, F.lit("A"))
        .alias("o_orderstatus"),
        F.count(F.lit(1)).alias("line_count"),
    )


UPSERT_SQL = """
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    batch AS (
        SELECT l_orderkey AS o_orderkey, max(l_extendedprice) AS o_totalprice,
               max(l_returnflag) FILTER (l_returnflag <> 'N') AS o_orderstatus, count(*) AS line_count
        FROM lineitem GROUP BY l_orderkey)
    SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey, t.o_custkey,
           CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           t.o_orderdate, t.o_orderpriority, b.line_count
    FROM target t FULL JOIN batch b ON t.o_orderkey = b.o_orderkey
"""


def _upsert(t: Tables, strategy: str) -> DataFrame:
    target = t.orders.where("o_orderdate < timestamp_ntz'1999-01-01'")
    return upsert(target, _order_batch(t), ["o_orderkey"], strategy=strategy, deduplicated=True)


@query("upsert_outer", UPSERT_SQL)
def upsert_outer(t: Tables) -> DataFrame:
    """Columns missing from the batch, a new one, and NULLs that overwrite."""
    return _upsert(t, "outer")


@query("upsert_lookup", UPSERT_SQL)
def upsert_lookup(t: Tables) -> DataFrame:
    return _upsert(t, "lookup")


@query(
    "upsert_latest_batch",
    """
    WITH batch AS (
        SELECT event_id, user_id, event_type, value, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10'
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1),
    target AS (
        SELECT event_id, user_id, event_type, value, ts FROM events WHERE ts < TIMESTAMP '2024-01-10'
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1)
    SELECT * FROM batch
    UNION ALL
    SELECT * FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE b.user_id = t.user_id AND b.event_type = t.event_type)
    """,
)
def upsert_latest_batch(t: Tables) -> DataFrame:
    """A batch that repeats keys: it is reduced to its latest row per key first."""
    from pitsync.operators.dedupe import latest_per_key

    keys, order, ties = ["user_id", "event_type"], [By("ts")], [By("event_id")]
    events = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    early, late = events.where("ts < timestamp_ntz'2024-01-10'"), events.where("ts >= timestamp_ntz'2024-01-10'")
    return upsert(latest_per_key(early, keys, order, ties), late, keys, order, ties)


@query(
    "upsert_load_stamp",
    """
    SELECT c.c_custkey, c.c_name, coalesce(s.s_nationkey, c.c_nationkey) AS c_nationkey, c.c_acctbal, c.c_mktsegment,
           TIMESTAMP '2023-01-01' AS data_inserted_at
    FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey WHERE c.c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT s_suppkey, NULL, s_nationkey, NULL, NULL, TIMESTAMP '2024-02-01 06:00:00' FROM supplier
    WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
    """,
)
def upsert_load_stamp(t: Tables) -> DataFrame:
    """Inserted rows get the run's load stamp, updated rows keep theirs."""
    target = t.customer.where("c_mktsegment <> 'MACHINERY'").withColumn(
        "data_inserted_at", F.expr("timestamp_ntz'2023-01-01'")
    )
    batch = t.supplier.select(F.col("s_suppkey").alias("C_CUSTKEY"), F.col("s_nationkey").alias("C_NATIONKEY"))
    return upsert(target, batch, ["c_custkey"], run_ts=RUN_TS)


@query(
    "schema_evolution",
    """
    SELECT CAST(c_custkey AS BIGINT) AS party_key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    """,
)
def schema_evolution(t: Tables) -> DataFrame:
    """A narrow column widens and a new one is added to the target."""
    target = t.customer.selectExpr("c_custkey AS party_key", "c_name AS name", "c_nationkey AS nation")
    batch = t.supplier.selectExpr(
        "s_suppkey AS party_key", "s_name AS name", "CAST(s_nationkey AS BIGINT) AS nation", "s_acctbal AS balance"
    )
    return append(target, batch)


@query(
    "key_violations",
    """
    SELECT doc_id, quality, count(*) AS row_count,
           CASE WHEN doc_id IS NULL OR quality IS NULL THEN 'null_key' ELSE 'repeated_key' END AS reason
    FROM (SELECT l.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
          UNION ALL SELECT doc_id, quality FROM labels WHERE toxic = 1)
    GROUP BY ALL HAVING count(*) > 1 OR doc_id IS NULL OR quality IS NULL
    """,
)
def broken_keys(t: Tables) -> DataFrame:
    labels = t.labels
    joined = t.documents.selectExpr("doc_id AS document").join(labels, F.col("document") == F.col("doc_id"), "left")
    rows = joined.select("doc_id", "quality").unionByName(labels.where("toxic = 1").select("doc_id", "quality"))
    return key_violations(rows, ["doc_id", "quality"])


@query(
    "chunk_order",
    """
    WITH target AS (SELECT o_orderkey, o_orderpriority AS note, o_totalprice AS price FROM orders),
    batch AS (
        SELECT l_orderkey AS o_orderkey, l_returnflag AS note, l_extendedprice AS price FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber DESC NULLS FIRST, l_shipdate DESC NULLS FIRST, l_extendedprice DESC NULLS FIRST,
                     l_returnflag DESC NULLS FIRST) = 1)
    SELECT * FROM batch
    UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey)
    """,
)
def chunk_order(t: Tables) -> DataFrame:
    """Chunks (here the line number) applied in one pass: the last one wins."""
    target = t.orders.selectExpr("o_orderkey", "o_orderpriority AS note", "o_totalprice AS price")
    batch = t.lineitem.selectExpr(
        "l_orderkey AS o_orderkey", "l_returnflag AS note", "l_extendedprice AS price", "l_linenumber AS chunk_no", "l_shipdate"
    )
    applied = upsert_chunks(
        target, batch, ["o_orderkey"], "chunk_no", "l_shipdate", ties=[By("price"), By("note")]
    )
    return applied.drop("l_shipdate")


def hash_sql(*columns: str, text: tuple[str, ...] = ()) -> str:
    """The row hash of some columns in the oracle's SQL; ``text`` names the texts."""
    parts = []
    for c in columns:
        value = f"CAST({c} AS VARCHAR)"
        if c in text:
            value = f"CAST(length({c}) AS VARCHAR) || ':' || {c}"
        parts.append(f"coalesce({value}, '-')")
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "pending_files",
    """
    SELECT DISTINCT 'orders' AS table_name, 'r1' AS run_id, strftime(o_orderdate, '%Y-%m') AS file FROM orders
    WHERE last_day(o_orderdate) >= DATE '1998-03-31'
    """,
)
def months_to_load(t: Tables) -> DataFrame:
    """Months as files: those fully loaded are skipped, a half loaded one is due again."""
    def files(orders: DataFrame) -> DataFrame:
        monthly = orders.withColumn("file", F.date_format("o_orderdate", "yyyy-MM"))
        return hash_groups(monthly, ["file"], ORDER_COLUMNS).select(
            F.lit("orders").alias("table_name"),
            F.lit("r1").alias("run_id"),
            "file",
            F.col("row_hash").alias("checksum_sha256"),
        )

    loaded = files(t.orders.where("o_orderdate < timestamp_ntz'1998-03-15'"))
    return pending_files(files(t.orders), loaded).drop("checksum_sha256")


def _state(t: Tables) -> DataFrame:
    """Events as state rows: users are tables; a low value resets a table's mark."""
    return t.events.select(
        F.col("user_id").alias("table_name"),
        F.col("event_id").alias("rows_exported"),
        F.col("ts").alias("updated_at"),
        (F.col("value") < 5).alias("is_reset"),
    )


@query(
    "current_marks",
    """
    SELECT user_id AS table_name, event_id AS rows_exported, ts AS updated_at, value < 5 AS is_reset FROM (
        SELECT * FROM events QUALIFY row_number() OVER (
            PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS FIRST) = 1)
    WHERE NOT coalesce(value < 5, false)
    """,
)
def marks_in_force(t: Tables) -> DataFrame:
    return current_marks(_state(t), ties=[By("rows_exported")])


@query(
    "mark_history",
    """
    SELECT user_id AS table_name, event_id AS rows_exported, ts AS updated_at, value < 5 AS is_reset,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS FIRST) - 1 AS INTEGER) AS age
    FROM events QUALIFY age <= 10
    """,
)
def history_of_marks(t: Tables) -> DataFrame:
    return mark_history(_state(t), ties=[By("rows_exported")])


# ---- files ------------------------------------------------------------------------------


@query(
    "bounded_files",
    "SELECT count(*) AS total_rows, true AS within_limit FROM orders",
)
def bounded_files(t: Tables) -> DataFrame:
    path, limit = work_dir(t.spark, "bounded"), 4000
    write_layout(t.orders, path, LayoutSpec(max_records=limit))
    return rows_per_file(t.spark, path).agg(
        F.sum("rows").cast("long").alias("total_rows"), (F.max("rows") <= limit).alias("within_limit")
    )


@query("layout_round_trip", "SELECT * FROM lineitem")
def layout_round_trip(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "layout")
    layout = LayoutSpec(
        sort_keys=("L_ORDERKEY", "l_linenumber", "not_there"),
        clustering="range",
        dictionary=("l_returnflag", "l_linestatus"),
    )
    write_layout(t.lineitem, path, layout)
    return t.spark.read.parquet(path)


@query("curve_layout", "SELECT * FROM lineitem")
def curve_layout(t: Tables) -> DataFrame:
    """Rows along a curve over a number, a date and a text, in partitions and without."""
    plain, parted = work_dir(t.spark, "curve"), work_dir(t.spark, "curve-parts")
    layout = LayoutSpec(sort_keys=("l_orderkey", "l_shipdate", "l_linestatus"), clustering="curve")
    write_layout(t.lineitem, plain, layout)
    write_layout(t.spark.read.parquet(plain), parted, replace(layout, partition_by=("l_returnflag",)))
    return t.spark.read.parquet(parted).select(*t.lineitem.columns)


@query(
    "curve_skipping",
    """
    WITH cut AS (SELECT max(l_orderkey) // 10 AS k FROM lineitem),
    found AS (
        SELECT count(*) FILTER (l_orderkey < k) AS by_key, count(*) FILTER (l_shipdate < DATE '1995-09-01') AS by_date, count(*) AS n
        FROM lineitem, cut
    )
    SELECT layout, filtered, CAST(if(filtered = 'l_orderkey', by_key, by_date) AS BIGINT) AS rows_found, n AS rows_stored,
           layout = 'curve' OR filtered = 'l_orderkey' AS skips_half
    FROM found, (VALUES ('range'), ('curve')) l(layout), (VALUES ('l_orderkey'), ('l_shipdate')) f(filtered)
    """,
)
def curve_skipping(t: Tables) -> DataFrame:
    """A range layout skips files for its first key alone, a curve for both of its columns."""
    total, last = t.lineitem.agg(F.count("*"), F.max("l_orderkey")).first()
    ranges = {"l_orderkey": (0, last // 10), "l_shipdate": (datetime(1900, 1, 1), datetime(1995, 9, 1))}
    out = None
    for name in ("range", "curve"):
        path = work_dir(t.spark, f"skip-{name}")
        layout = LayoutSpec(sort_keys=tuple(ranges), clustering=name, max_records=max(1, total // 64))
        write_layout(t.lineitem, path, layout)
        for column, (low, high) in ranges.items():
            reach = files_reached(t.spark.read.parquet(path), column, low, high).select(
                F.lit(name).alias("layout"),
                F.lit(column).alias("filtered"),
                "rows_found",
                F.col("rows").alias("rows_stored"),
                (F.col("rows_reached") * 2 < F.col("rows")).alias("skips_half"),
            )
            out = reach if out is None else out.unionByName(reach)
    return out


@query(
    "file_manifest",
    "SELECT count(*) AS total_rows, true AS all_hashed, true AS all_sized FROM orders",
)
def file_manifest(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "manifest")
    write_layout(t.orders, path, LayoutSpec(max_records=4000))
    return manifest(t.spark, path).agg(
        F.sum("rows").cast("long").alias("total_rows"),
        (F.min(F.length("checksum_sha256")) == 64).alias("all_hashed"),
        (F.min("size_bytes") > 0).alias("all_sized"),
    )


@query("manifest_verification", "SELECT count(*) AS ok_rows, CAST(0 AS BIGINT) AS bad_files FROM orders")
def manifest_verification(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "verify")
    write_layout(t.orders, path, LayoutSpec(max_records=4000))
    listed = manifest(t.spark, path, checksum="rows")
    status = verify(listed, manifest(t.spark, path, checksum="rows"))
    return listed.join(status, "file").agg(
        F.sum(F.when(F.col("status") == "ok", F.col("rows"))).cast("long").alias("ok_rows"),
        F.count_if(F.col("status") != "ok").alias("bad_files"),
    )


@query(
    "size_estimate",
    """
    SELECT count(*) FILTER (o_totalprice > 200000) AS row_count,
           CAST(round(count(*) FILTER (o_totalprice > 200000) / count(*), 2) AS DOUBLE) AS size_share FROM orders
    """,
)
def estimated_size(t: Tables) -> DataFrame:
    """Estimate for a filtered plan from stored bytes per row; as bytes depend on the
    writer, it is shown as a share of the stored size."""
    path = work_dir(t.spark, "estimate")
    write_layout(t.orders, path)
    totals = manifest_totals(manifest(t.spark, path, checksum="rows"))
    stored = totals.select("total_size_bytes").scalar()
    estimate = size_estimate(t.orders.where("o_totalprice > 200000"), stored, totals.select("total_rows").scalar())
    return estimate.select("row_count", F.round(F.col("size_bytes") / stored, 2).alias("size_share"))


@query("table_info", "SELECT count(*) AS row_count, true AS has_size FROM lineitem")
def table_info(t: Tables) -> DataFrame:
    """Row count and stored size of a table; bytes depend on the writer."""
    path = work_dir(t.spark, "info")
    write_layout(t.lineitem, path)
    size = file_listing(t.spark, path).agg(F.sum("size_bytes").alias("b")).scalar()
    counted = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("row_count", (size > 0).alias("has_size"))


@query(
    "layout_comparison",
    """
    SELECT layout, count(*) AS row_count, true AS has_size
    FROM lineitem, (VALUES ('zstd_3'), ('zstd_15'), ('types'), ('zstd_15_types')) v(layout) GROUP BY layout
    """,
)
def layout_comparison(t: Tables) -> DataFrame:
    """Four layouts written, measured and read back; sizes and times depend on the machine."""
    root, layouts = work_dir(t.spark, "compare"), standard_layouts(("l_orderkey", "l_linenumber"))
    measured = compare_layouts(t.spark, t.lineitem, root, layouts)
    rows = None
    for name in layouts:
        part = t.spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        part = part.withColumn("layout", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return measured.join(rows, "layout").select("layout", "row_count", (F.col("size_bytes") > 0).alias("has_size"))


@query(
    "partitioned_upsert",
    """
    SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(b.order_year, t.order_year) AS order_year,
           coalesce(b.price, t.price) AS price
    FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice AS price FROM orders
          WHERE o_orderpriority <> '1-URGENT') t
    FULL JOIN (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice + 1 AS price FROM orders
               WHERE o_orderdate >= TIMESTAMP '2000-01-01') b
    ON t.o_orderkey = b.o_orderkey AND t.order_year = b.order_year
    """,
)
def partitioned_upsert(t: Tables) -> DataFrame:
    """A batch touching two years rewrites just those partitions of the target."""
    from pitsync.operators.merge import changed_partitions

    root = work_dir(t.spark, "partitions")
    yearly = LayoutSpec(sort_keys=("o_orderkey",), partition_by=("order_year",))
    base = t.orders.where("o_orderpriority <> '1-URGENT'").selectExpr(
        "o_orderkey", "CAST(year(o_orderdate) AS INT) AS order_year", "o_totalprice AS price"
    )
    write_layout(base, f"{root}/target", yearly)
    batch = t.orders.where("o_orderdate >= timestamp_ntz'2000-01-01'").selectExpr(
        "o_orderkey", "CAST(year(o_orderdate) AS INT) AS order_year", "o_totalprice + 1 AS price"
    )
    write_layout(batch, f"{root}/batch")
    batch, target = (t.spark.read.parquet(f"{root}/{x}") for x in ("batch", "target"))
    touched = changed_partitions(target, batch, ["order_year"])
    result = upsert(touched, batch, ["o_orderkey", "order_year"])
    overwrite_partitions(result, f"{root}/target", f"{root}/stage", yearly)
    return t.spark.read.parquet(f"{root}/target").select("o_orderkey", "order_year", "price")


@query(
    "sync_round_trip",
    """
    SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1
    """,
)
def sync_round_trip(t: Tables) -> DataFrame:
    """Two exports and imports of a table, the second one only above the stored mark."""
    ws = Workspace(t.spark, work_dir(t.spark, "sync"))
    spec = TableSpec(
        "orders", "orders", sync_mode="upsert", merge_keys=("o_custkey",), watermark="o_orderdate",
        order_by="o_orderdate", ties=("o_orderkey",),
    )
    early = t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'")
    for run, source in (("r1", early), ("r2", t.orders)):
        export_table(ws, spec, {"orders": source}, run, run_ts=RUN_TS)
        import_table(ws, spec, run, run_ts=RUN_TS)
    return ws.target("orders").read().drop("data_inserted_at")


@query(
    "import_from_listing",
    """
    SELECT 'customer' AS table_name, 'full' AS sync_mode, count(*) AS row_count, false AS failed, count(*) AS target_rows FROM customer
    UNION ALL SELECT 'orders', 'upsert', count(DISTINCT o_custkey), false, count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'supplier', 'full', 0, true, 0
    """,
)
def import_from_listing(t: Tables) -> DataFrame:
    """Tables loaded as a delivery lists them; one that is listed, but not there, fails alone."""
    ws = Workspace(t.spark, work_dir(t.spark, "delivery"))
    specs = [TableSpec("customer", "customer"), TableSpec("orders", "orders", sync_mode="upsert", merge_keys=("o_custkey",), order_by="o_orderdate", ties=("o_orderkey",))]
    done = [export_table(ws, s, {s.name: getattr(t, s.name)}, "r1", run_ts=RUN_TS) for s in specs]
    results = [(d["table_name"], d["sync_mode"], d["rows"], None, None) for d in done] + [("supplier", None, 1, None, None)]
    results = t.spark.createDataFrame(results, "table_name string, sync_mode string, total_rows long, total_chunks long, folder_id string")
    listed = [(s.name, s.sync_mode, ",".join(s.merge_keys) or None, s.watermark, s.target) for s in specs]
    listed = t.spark.createDataFrame(listed, "name string, sync_mode string, merge_keys string, watermark_column string, target string")
    import_listing(ws, delivery_listing(results, listed), "r1", run_ts=RUN_TS)
    counts = [ws.target(s.name).read().groupBy().agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(s.name)) for s in specs]
    counts = counts[0].unionByName(counts[1])
    log = ws.run_log().where("run_type = 'import'").join(counts, F.col("table_name") == F.col("name"), "left")
    return log.select("table_name", "sync_mode", "row_count", "failed", F.coalesce("n", F.lit(0)).cast("long").alias("target_rows"))


@query("guarded_reload", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def guarded_reload(t: Tables) -> DataFrame:
    """A reload that lacks a column is refused, and one with a new column is loaded."""
    ws = Workspace(t.spark, work_dir(t.spark, "guard"))
    spec = TableSpec("orders", "orders")
    reloads = (t.orders, t.orders.drop("o_orderpriority"), t.orders.withColumn("order_year", F.year("o_orderdate")))
    refused = []
    for run, source in zip(("r1", "r2", "r3"), reloads, strict=True):
        export_table(ws, spec, {"orders": source}, run, run_ts=RUN_TS)
        try:
            import_table(ws, spec, run, run_ts=RUN_TS, guard_schema=True)
        except ValueError:
            refused.append(run)
    if refused != ["r2"]:
        raise RuntimeError(f"refused: {refused}")
    return ws.target("orders").read().drop("data_inserted_at")


@query(
    "upsert_bucketed",
    """
    SELECT o_orderkey, o_custkey, o_orderdate,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def upsert_bucketed(t: Tables) -> DataFrame:
    """Orders kept in hash buckets of their key; later ones come again with a new price."""
    ws = Workspace(t.spark, work_dir(t.spark, "buckets"))
    spec = TableSpec("orders", "orders", sync_mode="upsert", merge_keys=("o_orderkey",), watermark="o_orderdate", order_by="o_orderdate", buckets=16)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    late = orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    apply_batch(ws, spec, orders, "r1", run_ts=RUN_TS)
    apply_batch(ws, spec, late, "r2", run_ts=RUN_TS)
    return ws.partitioned("orders").read().select(*orders.columns)


@query(
    "sync_odd_paths",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def sync_odd_paths(t: Tables) -> DataFrame:
    """Export and import under a root with a space and signs, next to a stray file."""
    ws = Workspace(t.spark, f"{work_dir(t.spark, 'odd')}/a b%20#+c")
    spec = TableSpec("customer", "customer", sync_mode="incremental", watermark="c_custkey", order_by="c_custkey")
    source = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    export_table(ws, spec, {"customer": source}, "r1", run_ts=RUN_TS)
    source.where("c_custkey < 10").write.mode("append").parquet(ws.export_path("r1", "customer"))
    import_table(ws, spec, "r1", run_ts=RUN_TS)
    return ws.target("customer").read().drop("data_inserted_at")


@query("target_load", "SELECT * FROM supplier")
def target_load(t: Tables) -> DataFrame:
    """A full load twice over: the second replaces the first."""
    ws = Workspace(t.spark, work_dir(t.spark, "load"))
    spec = TableSpec("supplier", "supplier")
    apply_batch(ws, spec, t.supplier.where("s_acctbal < 0"), "r1", fresh=True, run_ts=RUN_TS)
    apply_batch(ws, spec, t.supplier, "r2", fresh=True, run_ts=RUN_TS)
    return ws.target("supplier").read().drop("data_inserted_at")


# ---- streams ----------------------------------------------------------------------------

_THIRDS = (
    "ts < timestamp_ntz'2024-01-11'",
    "ts >= timestamp_ntz'2024-01-11' AND ts < timestamp_ntz'2024-01-21'",
    "ts >= timestamp_ntz'2024-01-21'",
)


@query("stream_ingest", "SELECT * FROM events")
def stream_ingest(t: Tables) -> DataFrame:
    """Files that arrive in three deliveries load once each, over three stream runs."""
    root, events = work_dir(t.spark, "ingest"), t.events
    for third in _THIRDS:
        events.where(third).write.mode("append").parquet(f"{root}/in")
        ingest_available(file_stream(t.spark, f"{root}/in", events.schema), f"{root}/out", f"{root}/ckpt")
    return t.spark.read.parquet(f"{root}/out")


@query(
    "stream_upsert",
    """
    SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-02-01 06:00:00' AS data_inserted_at FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
    """,
)
def stream_upsert(t: Tables) -> DataFrame:
    root, events = work_dir(t.spark, "upsert"), t.events
    table = SnapshotTable(t.spark, f"{root}/target")
    for third in _THIRDS:
        events.where(third).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(t.spark, f"{root}/in", events.schema)
        upsert_stream(stream, table, ["user_id"], ["ts", "event_id"], f"{root}/ckpt", lambda batch_id: RUN_TS)
    return table.read()


@query(
    "stream_upsert_bucketed",
    """
    SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-02-01 06:00:00' AS data_inserted_at FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
    """,
)
def stream_upsert_bucketed(t: Tables) -> DataFrame:
    """The same target in key buckets: a micro-batch reads and writes those it touches."""
    root, events = work_dir(t.spark, "upsert-bucketed"), t.events
    table = PartitionedTable(t.spark, f"{root}/target")
    apply = bucketed_batch(table, ["user_id"], ["ts", "event_id"], 16, f"{root}/stage", lambda batch_id: RUN_TS)
    for third in _THIRDS:
        events.where(third).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(t.spark, f"{root}/in", events.schema).writeStream.foreachBatch(apply)
        stream.option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination()
    return table.read().drop(BUCKET)


# ---- hashes and change detection --------------------------------------------------------


@query(
    "row_hash_customer",
    f"SELECT c_custkey, {hash_sql('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment', text=('c_name', 'c_mktsegment'))} AS row_hash FROM customer",
)
def row_hash_customer(t: Tables) -> DataFrame:
    return hash_rows(t.customer, ["c_custkey"])


@query(
    "row_hash_nulls",
    f"""
    SELECT d.doc_id, {hash_sql('d.lang', 'l.quality', 'l.toxic', 'd.text', text=('d.lang', 'd.text'))} AS row_hash
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def row_hash_nulls(t: Tables) -> DataFrame:
    joined = t.documents.join(t.labels, "doc_id", "left")
    return hash_rows(joined, ["doc_id"], ["lang", "quality", "toxic", "text"])


@query(
    "group_digest",
    """
    SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS rows,
           o_orderpriority = '1-URGENT' OR year(o_orderdate) >= 2001 AS differs
    FROM orders GROUP BY ALL
    """,
)
def group_digest(t: Tables) -> DataFrame:
    """Digests of groups against those of an older copy of the table."""
    keys = ["o_orderpriority", "order_year"]

    def digests(orders: DataFrame) -> DataFrame:
        return hash_groups(orders.withColumn("order_year", F.year("o_orderdate")), keys, ORDER_COLUMNS)

    old = digests(_old_orders(t)).select(*keys, F.col("row_hash").alias("old_hash"))
    joined = digests(t.orders).join(old, keys, "left")
    return joined.select(*keys, "rows", (~F.col("row_hash").eqNullSafe(F.col("old_hash"))).alias("differs"))


def _old_orders(t: Tables) -> DataFrame:
    """Orders before an update: urgent ones were cheaper, the last year did not exist, and
    some keys have gone since."""
    gone = t.supplier.select((-F.col("s_suppkey") - 1).alias("o_orderkey")).selectExpr(
        "o_orderkey", "0L AS o_custkey", "'X' AS o_orderstatus", "0D AS o_totalprice",
        "timestamp_ntz'1994-01-01' AS o_orderdate", "'0-GONE' AS o_orderpriority",
    )
    before = t.orders.where("o_orderdate < timestamp_ntz'2001-01-01'").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice")),
    )
    return before.unionByName(gone)


CHANGES_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN 'new'
        WHEN o_orderpriority = '1-URGENT' THEN 'changed' ELSE 'unchanged' END AS status FROM orders
    UNION ALL SELECT -s_suppkey - 1, 'deleted' FROM supplier
"""


def _status(t: Tables) -> DataFrame:
    keys = ["o_orderkey"]
    return diff_hashes(hash_rows(_old_orders(t), keys), hash_rows(t.orders, keys), keys)


@query("change_detection_sha256", CHANGES_SQL)
def change_detection_sha256(t: Tables) -> DataFrame:
    return _status(t)


@query("change_detection", CHANGES_SQL)
def change_detection(t: Tables) -> DataFrame:
    return diff_rows(_old_orders(t), t.orders, ["o_orderkey"])


@query(
    "change_detection_nested",
    """
    WITH old AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN [l_partkey, NULL, l_suppkey] ELSE [l_partkey, l_suppkey, NULL] END AS a,
        l_partkey AS p, l_linestatus = 'O' AS x FROM lineitem),
    new AS (SELECT l_orderkey, l_linenumber, [l_partkey, l_suppkey, NULL] AS a, l_partkey AS p, l_linestatus = 'O' OR l_returnflag = 'R' AS x FROM lineitem),
    o AS (SELECT l_orderkey, l_linenumber, list_sort(list(a::VARCHAR || p || x)) AS v FROM old GROUP BY ALL),
    n AS (SELECT l_orderkey, l_linenumber, list_sort(list(a::VARCHAR || p || x)) AS v FROM new GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, CASE WHEN o.v = n.v THEN 'unchanged' ELSE 'changed' END AS status FROM o JOIN n USING (l_orderkey, l_linenumber)
    """,
)
def change_detection_nested(t: Tables) -> DataFrame:
    """Rows that differ only by where a NULL stands in an array or a struct."""
    keys, part = ["l_orderkey", "l_linenumber"], F.col("l_partkey")

    def version(first: Column, moved: Column) -> DataFrame:
        nothing = F.lit(None).cast("long")
        listed = F.when(first, F.array(part, nothing, "l_suppkey")).otherwise(F.array(part, F.col("l_suppkey"), nothing))
        return t.lineitem.select(*keys, listed.alias("a"), F.struct(F.when(moved, part).alias("x"), F.when(~moved, part).alias("y")).alias("s"))

    old = version(F.col("l_returnflag") == "A", F.col("l_linestatus") == "O")
    return diff_rows(old, version(F.lit(False), (F.col("l_linestatus") == "O") | (F.col("l_returnflag") == "R")), keys)


@query(
    "unreadable_copies",
    """
    SELECT doc_id, CASE WHEN lang = 'fr' THEN 'unreadable' WHEN n_chars > 2000 THEN 'changed' ELSE 'unchanged' END AS status
    FROM documents
    """,
)
def unreadable_copies(t: Tables) -> DataFrame:
    """Sealed copies against the documents: some were sealed with another key, some are old."""
    keys = [secret_column(t.spark, derive_key(p, b"sixteen byte slt")) for p in ("this run", "lost")]
    docs = t.documents.select("doc_id", "lang", "n_chars", "text")
    copies = docs.withColumn("text", F.when(F.col("n_chars") > 2000, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    sealed = seal_rows(copies.where("lang <> 'fr'"), "text", keys[0]).unionByName(
        seal_rows(copies.where("lang = 'fr'"), "text", keys[1])
    )
    old = open_rows(sealed, "text", keys[0]).select("doc_id", F.sha2("text", 256).alias("row_hash"))
    new = docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("row_hash"))
    return diff_hashes(old, new, ["doc_id"])


@query(
    "export_statistics",
    f"""
    SELECT count(*) AS total, count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'changed') AS changed,
           count(*) FILTER (status = 'unchanged') AS unchanged, count(*) FILTER (status IN ('new', 'changed')) AS written,
           round(count(*) FILTER (status = 'unchanged') * 100.0 / count(*), 4)::DOUBLE AS unchanged_pct
    FROM ({CHANGES_SQL}) WHERE status <> 'deleted'
    """,
)
def export_statistics(t: Tables) -> DataFrame:
    return change_statistics(_status(t))


@query(
    "skip_unchanged_write",
    """
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS order_year, o_totalprice,
           year(o_orderdate) >= 2001 AS rewritten FROM orders
    """,
)
def skip_unchanged_write(t: Tables) -> DataFrame:
    """Yearly chunks: only chunks whose digest differs are written again."""
    root = work_dir(t.spark, "skip")
    yearly = LayoutSpec(partition_by=("order_year",))
    rows = t.orders.selectExpr("o_orderkey", "CAST(year(o_orderdate) AS INT) AS order_year", "o_totalprice")
    old = rows.where("order_year < 2001")
    write_layout(old.withColumn("rewritten", F.lit(False)), f"{root}/out", yearly)
    status = diff_hashes(hash_groups(old, ["order_year"]), hash_groups(rows, ["order_year"]), ["order_year"])
    due = rows_to_write(rows, status, ["order_year"]).withColumn("rewritten", F.lit(True))
    overwrite_partitions(due, f"{root}/out", f"{root}/stage", yearly)
    return t.spark.read.parquet(f"{root}/out").select("o_orderkey", "order_year", "o_totalprice", "rewritten")


# ---- identifiers and sealing ------------------------------------------------------------


@query(
    "pseudonym",
    f"SELECT c_custkey, substr(sha256('{SALT}:' || c_name || ':customer'), 1, 16) AS customer_id FROM customer",
)
def pseudonym(t: Tables) -> DataFrame:
    salt = secret_column(t.spark, SALT)
    return t.customer.select("c_custkey", keyed_id(F.col("c_name"), "customer", salt).alias("customer_id"))


@query(
    "file_identifiers",
    f"""
    SELECT c_name AS table_name, substr(sha256('{SALT}:' || c_name || ':folder'), 1, 16) AS folder_id,
           substr(sha256('{SALT}:' || c_name || ':chunk:' || c_nationkey || ':data'), 1, 16) AS chunk_id,
           substr(sha256('{SALT}:' || c_name || ':manifest'), 1, 16) AS manifest_id,
           substr(sha256('{SALT}:' || c_name || ':ddl'), 1, 16) AS ddl_id,
           substr(sha256('{SALT}:' || c_name || ':metadata:20240131:'), 1, 16) AS archived_id
    FROM customer
    """,
)
def file_identifiers(t: Tables) -> DataFrame:
    salt, name = secret_column(t.spark, SALT), F.col("c_name")
    return t.customer.select(
        name.alias("table_name"),
        table_folder_id(name, salt).alias("folder_id"),
        chunk_file_id(name, F.col("c_nationkey"), salt).alias("chunk_id"),
        manifest_id(name, salt).alias("manifest_id"),
        metadata_file_id(name, "ddl", salt=salt).alias("ddl_id"),
        metadata_file_id(name, "metadata", F.lit("20240131"), salt).alias("archived_id"),
    )


@query(
    "id_collisions",
    f"""
    SELECT short_id, count(*) AS keys FROM (
        SELECT DISTINCT substr(sha256('{SALT}:' || o_custkey || ':order'), 1, 4) AS short_id, o_custkey FROM orders)
    GROUP BY short_id HAVING count(*) > 1
    """,
)
def colliding_ids(t: Tables) -> DataFrame:
    salt = secret_column(t.spark, SALT)
    short = t.orders.withColumn("short_id", keyed_id(F.col("o_custkey"), "order", salt, length=4))
    return id_collisions(short, "short_id", "o_custkey")


@query(
    "index_lookup",
    f"""
    SELECT s_suppkey, s_name, CASE WHEN c_name IS NOT NULL THEN substr(sha256('{SALT}:' || c_name || ':folder'), 1, 16) END AS folder_id
    FROM supplier LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) ON s_suppkey = c_custkey
    """,
)
def index_lookup(t: Tables) -> DataFrame:
    salt = secret_column(t.spark, SALT)
    index = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("s_suppkey"), table_folder_id(F.col("c_name"), salt).alias("folder_id")
    )
    return look_up(t.supplier.select("s_suppkey", "s_name"), index, "s_suppkey", "folder_id")


@query("seal_round_trip", "SELECT doc_id, text, true AS intact FROM documents")
def seal_round_trip(t: Tables) -> DataFrame:
    key = secret_column(t.spark, derive_key("round trip", b"sixteen byte slt"))
    sealed = seal_rows(t.documents.select("doc_id", "text"), "text", key)
    opened = open_rows(sealed, "text", key)
    return opened.select("doc_id", F.col("text").cast("string").alias("text"), "intact")


@query("wrong_key", "SELECT doc_id, CAST(NULL AS VARCHAR) AS text, false AS intact FROM documents")
def wrong_key(t: Tables) -> DataFrame:
    right = secret_column(t.spark, derive_key("right", b"sixteen byte slt"))
    wrong = secret_column(t.spark, derive_key("wrong", b"sixteen byte slt"))
    opened = open_rows(seal_rows(t.documents.select("doc_id", "text"), "text", right), "text", wrong)
    return opened.select("doc_id", F.col("text").cast("string").alias("text"), "intact")


@query("sealed_files", "SELECT count(*) AS total_rows, true AS all_intact FROM orders")
def sealed_files(t: Tables) -> DataFrame:
    """Chunk files sealed and opened again; every file comes back byte for byte."""
    path = work_dir(t.spark, "seal")
    write_layout(t.orders, path, LayoutSpec(max_records=4000))
    opened = open_files(seal_files(t.spark, path, "a password"), "a password")
    listed = manifest(t.spark, path)
    checked = listed.join(opened, "file", "left").withColumn(
        "same", F.col("intact") & (F.sha2("content", 256) == F.col("checksum_sha256"))
    )
    return checked.agg(F.sum("rows").cast("long").alias("total_rows"), F.every(F.coalesce("same", F.lit(False))).alias("all_intact"))


@query("sealed_sync", "SELECT * FROM orders")
def sealed_sync(t: Tables) -> DataFrame:
    """Orders exported in sealed frames, in two runs, and imported into a target."""
    ws = Workspace(t.spark, work_dir(t.spark, "sealed-sync"))
    spec = TableSpec("orders", "orders", sync_mode="upsert", merge_keys=("o_orderkey",), watermark="o_orderdate", order_by="o_orderdate")
    for run_id, until in (("r1", "1998-01-01"), ("r2", "9999-01-01")):
        orders = t.orders.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
        export_table(ws, spec, {"orders": orders}, run_id, run_ts=RUN_TS, password=SALT)
        import_table(ws, spec, run_id, run_ts=RUN_TS, password=SALT)
    return ws.target("orders").read().drop("data_inserted_at")


_RANGED = TableSpec("orders", "orders", merge_keys=("o_orderkey",), order_by="o_orderdate")
_LATE = "o_orderdate >= timestamp_ntz'2001-06-01' AND o_orderpriority = '1-URGENT'"


def _order_states(t: Tables) -> list[DataFrame]:
    """Orders as they come in: all, some with new prices, the same again, and without small ones."""
    priced = t.orders.withColumn("o_totalprice", F.when(F.expr(_LATE), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return [t.orders, priced, priced, priced.where("o_totalprice >= 1500")]


@query(
    "skip_unchanged_export",
    """
    WITH o AS (SELECT *, substr(sha256(length(o_orderkey::VARCHAR) || ':' || o_orderkey), 1, 2) AS leaf,
        o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderpriority = '1-URGENT' AS late FROM orders),
    r AS (SELECT leaf, count(*) AS n, bool_or(late) AS priced, count(*) FILTER (o_totalprice + late::INT < 1500) AS gone FROM o GROUP BY leaf)
    SELECT 1 AS step, count(*) AS ranges, count(*) AS written, 0::BIGINT AS deleted, sum(n)::BIGINT AS rows_written FROM r
    UNION ALL SELECT 2, count(*), count(*) FILTER (priced), 0, coalesce(sum(n) FILTER (priced), 0) FROM r
    UNION ALL SELECT 3, count(*), 0, 0, 0 FROM r
    UNION ALL SELECT 4, count(*) FILTER (gone < n), count(*) FILTER (gone BETWEEN 1 AND n - 1), count(*) FILTER (gone = n),
        coalesce(sum(n - gone) FILTER (gone BETWEEN 1 AND n - 1), 0) FROM r
    """,
)
def skip_unchanged_export(t: Tables) -> DataFrame:
    """What four exports write, of which the third has nothing to do."""
    ws = Workspace(t.spark, work_dir(t.spark, "skip-unchanged"))
    done = [export_ranges(ws, _RANGED, {"orders": df}, f"r{n}") for n, df in enumerate(_order_states(t), 1)]
    columns = ("ranges", "written", "deleted", "rows_written")
    rows = [(n, *[d[c] for c in columns]) for n, d in enumerate(done, 1)]
    return t.spark.createDataFrame(rows, "step int, ranges long, written long, deleted long, rows_written long")


@query(
    "range_sync",
    """
    SELECT * REPLACE (o_totalprice + (o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderpriority = '1-URGENT')::INT AS o_totalprice)
    FROM orders WHERE o_totalprice + (o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderpriority = '1-URGENT')::INT >= 1500
    """,
)
def range_sync(t: Tables) -> DataFrame:
    """A target that follows four exports by the ranges that differ."""
    ws = Workspace(t.spark, work_dir(t.spark, "range-sync"))
    for n, df in enumerate(_order_states(t), 1):
        export_ranges(ws, _RANGED, {"orders": df}, f"r{n}")
        import_ranges(ws, _RANGED, f"r{n}")
    return ws.range_target("orders").read()
