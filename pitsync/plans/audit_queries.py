"""Queries for quality, type advice, catalogs, schema diffs and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.operators.advice import advise_types, dictionary_columns, reduction
from pitsync.operators.sketches import category_columns, column_sketches
from pitsync.operators.audit import delivery_listing, purpose_parts, run_purpose, run_summary
from pitsync.operators.catalog import (
    catalog,
    change_log_rows,
    classify,
    constraint_columns,
    evolve_actions,
    evolve_decision,
    first_extraction_rows,
    history_between,
    history_summary,
    latest_entries,
    migration_rows,
    observe_catalog,
    primary_key_columns,
    property_diff,
    same_key,
    schema_diff,
    structure_differences,
    summarise_changes,
    table_metadata,
    table_statistics,
)
from pitsync.operators.dedupe import duplicate_report
from pitsync.operators.quality import check_columns, failed, match_counts, validate
from pitsync.plans.registry import Tables, query

# ---- quality ----------------------------------------------------------------------------

LABEL_RULES = {
    "doc_id": {"not_null": True},
    "QUALITY": {"not_null": True, "null_rate_max": 0.5, "min_value": 1},
    "toxic": {"null_rate_max": 0.75, "min_value": 0},
    "score": {"not_null": True},
}
LABELLED_SQL = "(SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
FINDINGS_SQL = f"""
    SELECT 'doc_id' AS "column", 'not_null' AS "check", n_doc = 0 AS passed,
           CASE WHEN n_doc = 0 THEN 'OK' ELSE n_doc || ' null(s)' END AS detail FROM p
    UNION ALL SELECT 'QUALITY', 'not_null', n_quality = 0, CASE WHEN n_quality = 0 THEN 'OK' ELSE n_quality || ' null(s)' END FROM p
    UNION ALL SELECT 'QUALITY', 'null_rate_max', n_quality / n <= 0.5, 'null_rate=' || printf('%.4f', n_quality / n) || ' (max 0.5)' FROM p
    UNION ALL SELECT 'QUALITY', 'min_value', lo_quality >= 1, 'min=' || lo_quality || ' (expected >= 1)' FROM p
    UNION ALL SELECT 'toxic', 'null_rate_max', n_toxic / n <= 0.75, 'null_rate=' || printf('%.4f', n_toxic / n) || ' (max 0.75)' FROM p
    UNION ALL SELECT 'toxic', 'min_value', lo_toxic >= 0, 'min=' || lo_toxic || ' (expected >= 0)' FROM p
    UNION ALL SELECT 'score', 'column_exists', false, 'Column score not found in DataFrame'
"""
PROFILE_SQL = f"""
    WITH p AS (
        SELECT count(*) AS n, count(*) FILTER (doc_id IS NULL) AS n_doc, count(*) FILTER (quality IS NULL) AS n_quality,
               count(*) FILTER (toxic IS NULL) AS n_toxic, min(quality) AS lo_quality, min(toxic) AS lo_toxic
        FROM {LABELLED_SQL})
"""


def _labelled(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left")


@query("validate_labels", PROFILE_SQL + FINDINGS_SQL)
def validate_labels(t: Tables) -> DataFrame:
    return validate(_labelled(t), LABEL_RULES)


@query("failed_findings", f"{PROFILE_SQL} SELECT * FROM ({FINDINGS_SQL}) WHERE NOT passed")
def failed_findings(t: Tables) -> DataFrame:
    return failed(validate(_labelled(t), LABEL_RULES))


@query(
    "validate_orders",
    """
    SELECT 'o_orderdate' AS "column", 'min_value' AS "check", min(o_orderdate) >= TIMESTAMP '1995-01-01' AS passed,
           'min=' || CAST(min(o_orderdate) AS VARCHAR) || ' (expected >= 1995-01-01)' AS detail FROM orders
    UNION ALL
    SELECT 'o_totalprice', 'min_value', min(o_totalprice) >= 10000, 'min=' || CAST(min(o_totalprice) AS VARCHAR) || ' (expected >= 10000)' FROM orders
    UNION ALL
    SELECT 'o_orderkey', 'not_null', count(*) = count(o_orderkey),
           CASE WHEN count(*) = count(o_orderkey) THEN 'OK' ELSE (count(*) - count(o_orderkey)) || ' null(s)' END FROM orders
    """,
)
def validate_orders(t: Tables) -> DataFrame:
    rules = {
        "o_orderdate": {"min_value": "1995-01-01"},
        "o_totalprice": {"min_value": 10000},
        "o_orderkey": {"not_null": True},
    }
    return validate(t.orders, rules)


@query(
    "validate_as_text",
    """
    SELECT 'o_totalprice' AS "column", 'min_value' AS "check", CAST(min(o_totalprice) AS VARCHAR) >= '10000' AS passed,
           'min=' || CAST(min(o_totalprice) AS VARCHAR) || ' (expected >= 10000)' AS detail FROM orders
    """,
)
def validate_as_text(t: Tables) -> DataFrame:
    return validate(t.orders, {"o_totalprice": {"min_value": 10000}}, compat_string=True)


# ---- observed catalogs ------------------------------------------------------------------

INT, TEXT, DOUBLE, STAMP = "int", "text", "double", "stamp"


def observed_sql(table: str, columns: list[tuple[str, str, str]], source: str) -> str:
    """Oracle for an observed catalog; ``columns`` are ``(name, expression, kind)``."""
    parts = []
    for at, (name, expr, kind) in enumerate(columns, start=1):
        size = {
            INT: f"max(length(CAST(abs({expr}) AS VARCHAR)))",
            TEXT: f"max(length({expr}))",
        }.get(kind, "NULL")
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS kind, {at} AS position, "
            f"coalesce(count(*) > count({expr}), false) AS is_nullable, CAST({size} AS INTEGER) AS size FROM {source}"
        )
    return " UNION ALL ".join(parts)


CATALOG_SQL = """
    SELECT table_name, column_name,
           CASE kind WHEN 'int' THEN 'NUMBER' WHEN 'text' THEN 'VARCHAR' WHEN 'double' THEN 'DOUBLE' ELSE 'TIMESTAMP_NTZ' END AS data_type,
           is_nullable, CASE WHEN kind = 'text' THEN size END AS max_length,
           CASE WHEN kind = 'int' THEN size END AS "precision", position,
           CASE kind WHEN 'int' THEN CASE WHEN size <= 4 THEN 'SMALLINT' WHEN size <= 9 THEN 'INTEGER' WHEN size <= 18 THEN 'BIGINT' ELSE 'NUMERIC' END
                     WHEN 'text' THEN 'VARCHAR(' || size || ')' WHEN 'double' THEN 'DOUBLE PRECISION' ELSE 'TIMESTAMP' END AS target_type
"""
_SHOWN = ["table_name", "column_name", "data_type", "is_nullable", "max_length", "precision", "position", "target_type"]


@query(
    "observed_catalog",
    f"""{CATALOG_SQL} FROM ({observed_sql('lineitem', [
        ('l_orderkey', 'l_orderkey', INT), ('l_partkey', 'l_partkey', INT), ('l_suppkey', 'l_suppkey', INT),
        ('l_linenumber', 'l_linenumber', INT), ('l_quantity', 'l_quantity', DOUBLE),
        ('l_extendedprice', 'l_extendedprice', DOUBLE), ('l_discount', 'l_discount', DOUBLE), ('l_tax', 'l_tax', DOUBLE),
        ('l_returnflag', 'l_returnflag', TEXT), ('l_linestatus', 'l_linestatus', TEXT), ('l_shipdate', 'l_shipdate', STAMP),
    ], 'lineitem')})""",
)
def observed_lineitem(t: Tables) -> DataFrame:
    return observe_catalog(t.lineitem, "lineitem").select(*_SHOWN)


@query(
    "type_mapping",
    f"""{CATALOG_SQL} FROM ({observed_sql('documents', [
        ('doc_id', 'doc_id', INT), ('text', 'text', TEXT), ('lang', 'lang', TEXT), ('source', 'source', TEXT), ('n_chars', 'n_chars', INT),
    ], 'documents')} UNION ALL {observed_sql('labelled', [
        ('doc_id', 'doc_id', INT), ('quality', 'quality', INT), ('toxic', 'toxic', INT),
    ], LABELLED_SQL)})""",
)
def type_mapping(t: Tables) -> DataFrame:
    seen = observe_catalog(t.documents, "documents").unionByName(observe_catalog(_labelled(t), "labelled"))
    return seen.select(*_SHOWN)


def _old_catalog(t: Tables) -> DataFrame:
    party = t.customer.selectExpr(
        "c_custkey AS party_key", "c_name AS party_name", "c_nationkey AS nation_key", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    item = t.lineitem.selectExpr(
        "l_linenumber AS item_key", "l_linestatus AS note", "l_returnflag AS flag", "l_quantity AS amount", "l_shipdate AS day"
    )
    return observe_catalog(party, "PARTY").unionByName(observe_catalog(item, "item"))


def _new_catalog(t: Tables) -> DataFrame:
    party = t.supplier.selectExpr(
        "s_suppkey AS PARTY_KEY", "s_nationkey AS nation_key", "s_name AS party_name", "s_acctbal AS balance",
        "CASE WHEN s_acctbal < 0 THEN s_acctbal END AS debt",
    )
    item = t.orders.selectExpr(
        "o_orderkey AS item_key", "o_orderpriority AS note", "o_custkey AS flag",
        "CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS amount", "o_orderdate AS day",
    )
    return observe_catalog(party, "party").unionByName(observe_catalog(item, "item"))


_OLD_SQL = observed_sql("PARTY", [
    ("party_key", "c_custkey", INT), ("party_name", "c_name", TEXT), ("nation_key", "c_nationkey", INT),
    ("balance", "c_acctbal", DOUBLE), ("segment", "c_mktsegment", TEXT),
], "customer") + " UNION ALL " + observed_sql("item", [
    ("item_key", "l_linenumber", INT), ("note", "l_linestatus", TEXT), ("flag", "l_returnflag", TEXT),
    ("amount", "l_quantity", DOUBLE), ("day", "l_shipdate", STAMP),
], "lineitem")
_NEW_SQL = observed_sql("party", [
    ("PARTY_KEY", "s_suppkey", INT), ("nation_key", "s_nationkey", INT), ("party_name", "s_name", TEXT),
    ("balance", "s_acctbal", DOUBLE), ("debt", "CASE WHEN s_acctbal < 0 THEN s_acctbal END", DOUBLE),
], "supplier") + " UNION ALL " + observed_sql("item", [
    ("item_key", "o_orderkey", INT), ("note", "o_orderpriority", TEXT), ("flag", "o_custkey", INT),
    ("amount", "CASE WHEN o_totalprice > 1000 THEN o_totalprice END", DOUBLE), ("day", "o_orderdate", STAMP),
], "orders")
DIFF_SQL = f"""
    WITH o AS ({CATALOG_SQL} FROM ({_OLD_SQL})), n AS ({CATALOG_SQL} FROM ({_NEW_SQL})),
    j AS (
        SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.column_name, o.column_name) AS column_name,
               o.column_name AS o_name, n.column_name AS n_name, o.target_type AS o_type, n.target_type AS n_type,
               o.is_nullable AS o_null, n.is_nullable AS n_null, o.position AS o_pos, n.position AS n_pos
        FROM o FULL JOIN n ON upper(o.table_name) = upper(n.table_name) AND upper(o.column_name) = upper(n.column_name)),
    d AS (
        SELECT table_name, column_name, 'column_added' AS change, CAST(NULL AS VARCHAR) AS old_value, n_type AS new_value FROM j WHERE o_name IS NULL
        UNION ALL SELECT table_name, column_name, 'column_removed', o_type, NULL FROM j WHERE n_name IS NULL
        UNION ALL SELECT table_name, column_name, 'column_type_changed', o_type, n_type FROM j WHERE o_type <> n_type
        UNION ALL SELECT table_name, column_name, 'column_nullable_changed', CAST(o_null AS VARCHAR), CAST(n_null AS VARCHAR) FROM j WHERE o_null <> n_null
        UNION ALL SELECT table_name, column_name, 'column_position_changed', CAST(o_pos AS VARCHAR), CAST(n_pos AS VARCHAR) FROM j WHERE o_pos <> n_pos),
    c AS (
        SELECT *, CASE
            WHEN change = 'column_added' THEN true
            WHEN change = 'column_nullable_changed' THEN new_value = 'true'
            WHEN change = 'column_type_changed' THEN
                (old_value = 'SMALLINT' AND new_value IN ('INTEGER', 'BIGINT', 'NUMERIC'))
                OR (old_value = 'INTEGER' AND new_value IN ('BIGINT', 'NUMERIC'))
                OR (old_value = 'BIGINT' AND new_value = 'NUMERIC')
                OR (starts_with(old_value, 'VARCHAR(') AND new_value = 'TEXT')
                OR (starts_with(old_value, 'VARCHAR(') AND starts_with(new_value, 'VARCHAR(')
                    AND TRY_CAST(regexp_extract(new_value, '([0-9]+)', 1) AS INTEGER) >= TRY_CAST(regexp_extract(old_value, '([0-9]+)', 1) AS INTEGER))
            ELSE false END AS safe
        FROM d)
"""


def _diff(t: Tables) -> DataFrame:
    return schema_diff(_old_catalog(t), _new_catalog(t))


@query("schema_diff", f"{DIFF_SQL} SELECT * FROM d")
def observed_schema_diff(t: Tables) -> DataFrame:
    return _diff(t)


@query("classified_changes", f"{DIFF_SQL} SELECT table_name, column_name, change, old_value, new_value, coalesce(safe, false) AS safe FROM c")
def classified_changes(t: Tables) -> DataFrame:
    return classify(_diff(t))


@query(
    "evolve_decision",
    f"""{DIFF_SQL}
    SELECT table_name, count(*) FILTER (safe) AS safe_count, count(*) FILTER (NOT coalesce(safe, false)) AS breaking_count,
           count(*) FILTER (safe) AS action_count,
           CASE WHEN count(*) FILTER (NOT coalesce(safe, false)) > 0 THEN 'blocked' WHEN count(*) FILTER (safe) > 0 THEN 'success' ELSE 'no_changes' END AS status
    FROM c GROUP BY table_name
    """,
)
def evolution_decision(t: Tables) -> DataFrame:
    return evolve_decision(classify(_diff(t)))


@query(
    "evolve_forced",
    f"""{DIFF_SQL}
    SELECT table_name, column_name, change, CASE
        WHEN change = 'column_added' THEN 'add_column' WHEN change = 'column_type_changed' THEN 'alter_type'
        WHEN change = 'column_nullable_changed' AND new_value = 'true' THEN 'drop_not_null' ELSE 'ignored' END AS action
    FROM c
    """,
)
def evolve_forced(t: Tables) -> DataFrame:
    forced = evolve_actions(classify(_diff(t)), force=True)
    return forced.select("table_name", "column_name", "change", "action")


@query(
    "migration_log",
    f"""{DIFF_SQL}
    SELECT table_name, 'alter_table' AS action,
           string_agg(step, '; ' ORDER BY step) AS steps, 'Applied ' || count(*) || ' change(s)' AS summary, TIMESTAMP '2024-02-01' AS applied_at
    FROM (SELECT table_name, CASE
              WHEN change = 'column_added' THEN 'add_column ' || column_name || ' ' || new_value
              WHEN change = 'column_type_changed' THEN 'alter_type ' || column_name || ' ' || new_value
              WHEN change = 'column_nullable_changed' AND new_value = 'true' THEN 'drop_not_null ' || column_name END AS step
          FROM c WHERE safe)
    WHERE step IS NOT NULL GROUP BY table_name
    """,
)
def migration_log(t: Tables) -> DataFrame:
    return migration_rows(evolve_actions(classify(_diff(t))), "2024-02-01")


@query(
    "change_summary_text",
    f"""{DIFF_SQL},
    k AS (
        SELECT table_name, count(*) FILTER (change = 'column_added') AS a, count(*) FILTER (change = 'column_removed') AS r,
               count(*) FILTER (change = 'column_type_changed') AS t, count(*) FILTER (change = 'column_nullable_changed') AS n,
               count(DISTINCT change) FILTER (change = 'column_position_changed') AS x
        FROM d GROUP BY table_name)
    SELECT table_name, concat_ws(', ',
        CASE WHEN a > 0 THEN a || ' column' || CASE WHEN a > 1 THEN 's' ELSE '' END || ' added' END,
        CASE WHEN r > 0 THEN r || ' column' || CASE WHEN r > 1 THEN 's' ELSE '' END || ' removed' END,
        CASE WHEN t > 0 THEN t || ' type' || CASE WHEN t > 1 THEN 's' ELSE '' END || ' changed' END,
        CASE WHEN n > 0 THEN n || ' nullable constraint' || CASE WHEN n > 1 THEN 's' ELSE '' END || ' changed' END,
        CASE WHEN x > 0 THEN x || ' other change' || CASE WHEN x > 1 THEN 's' ELSE '' END END) AS summary
    FROM k
    """,
)
def change_summary_text(t: Tables) -> DataFrame:
    return summarise_changes(_diff(t))


@query(
    "change_log",
    f"""{DIFF_SQL}
    SELECT table_name, TIMESTAMP '2024-02-01' AS logged_at, 'schema_change' AS kind, change, column_name FROM d
    UNION ALL
    SELECT DISTINCT n.table_name, TIMESTAMP '2024-02-01', 'initial_extraction', NULL, NULL FROM n
    WHERE n.table_name NOT IN (SELECT table_name FROM o)
    """,
)
def change_log(t: Tables) -> DataFrame:
    changes = change_log_rows(_diff(t), "2024-02-01")
    first = first_extraction_rows(_new_catalog(t), _old_catalog(t), "2024-02-01")
    return changes.unionByName(first).drop("details")


@query(
    "structure_check",
    f"""{DIFF_SQL}
    SELECT lower(table_name) AS table_name, lower(column_name) AS column_name, 'missing_in_target' AS difference FROM d WHERE change = 'column_added'
    UNION ALL
    SELECT lower(table_name), lower(column_name), 'only_in_target' FROM d WHERE change = 'column_removed'
    """,
)
def structure_check(t: Tables) -> DataFrame:
    return structure_differences(_new_catalog(t), _old_catalog(t))


@query(
    "column_check",
    f"""
    WITH known AS ({CATALOG_SQL} FROM ({_NEW_SQL})),
    wanted AS (SELECT * FROM (VALUES ('party', 'party_key', 1), ('party', 'segment', 1), ('item', 'day', 2), ('item', 'AMOUNT', 1), ('other', 'day', 1)) v(table_name, column_name, times))
    SELECT table_name, column_name, CAST(times AS BIGINT) AS times, severity FROM (
        SELECT *, CASE WHEN NOT EXISTS (SELECT 1 FROM known k WHERE upper(k.table_name) = upper(w.table_name) AND upper(k.column_name) = upper(w.column_name)) THEN 'error'
                       WHEN times > 1 THEN 'warning' END AS severity FROM wanted w) WHERE severity IS NOT NULL
    """,
)
def column_check(t: Tables) -> DataFrame:
    wanted = [("party", "party_key"), ("party", "segment"), ("item", "day"), ("item", "day"), ("item", "AMOUNT"), ("other", "day")]
    requested = t.spark.createDataFrame(wanted, "table_name string, column_name string")
    return check_columns(requested, _new_catalog(t))


# ---- keys and constraints found in the data ---------------------------------------------

CANDIDATES = [
    ("customer", "customer_key", (1,)),
    ("customer", "customer_name", (2,)),
    ("supplier", "supplier_key", (1,)),
    ("orders", "orders_key", (1,)),
    ("orders", "orders_customer_day", (5, 2)),
    ("nation", "nation_region_key", (3, 1)),
    ("lineitem", "line_key", (1, 4)),
]
_CANDIDATE_SQL = [
    ("customer", "customer_key", ["c_custkey"]),
    ("customer", "customer_name", ["c_name"]),
    ("supplier", "supplier_key", ["s_suppkey"]),
    ("orders", "orders_key", ["o_orderkey"]),
    ("orders", "orders_customer_day", ["o_orderdate", "o_custkey"]),
    ("nation", "nation_region_key", ["n_regionkey", "n_nationkey"]),
    ("lineitem", "line_key", ["l_orderkey", "l_linenumber"]),
]
_UNIQUE_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, {cols} AS columns, "
    f"NOT EXISTS (SELECT 1 FROM {table} GROUP BY {', '.join(cols)} HAVING count(*) > 1) AS is_unique"
    for table, name, cols in _CANDIDATE_SQL
)


def _constraints(t: Tables) -> DataFrame:
    """Candidate keys and whether the data keeps them."""
    out = None
    for table, name, positions in CANDIDATES:
        df = getattr(t, table)
        report = duplicate_report(df, [df.columns[p - 1] for p in positions])
        row = report.select(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("constraint_name"),
            F.array(*[F.lit(p) for p in positions]).alias("key"),
            (F.col("surplus_rows") == 0).alias("is_unique"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _declared(t: Tables) -> DataFrame:
    return catalog(t.spark, {name: getattr(t, name) for name in ("customer", "supplier", "orders", "nation", "lineitem")})


@query(
    "constraint_columns",
    f"""
    SELECT table_name, constraint_name, array_to_string(columns, ',') AS key_columns,
           list_sort(columns) = ['n_nationkey', 'n_regionkey'] AS is_nation_key
    FROM ({_UNIQUE_SQL}) WHERE is_unique
    """,
)
def key_columns_of_constraints(t: Tables) -> DataFrame:
    named = constraint_columns(_constraints(t).where("is_unique"), _declared(t))
    return named.select(
        "table_name",
        "constraint_name",
        F.concat_ws(",", "columns").alias("key_columns"),
        same_key(F.col("columns"), ["N_NATIONKEY", "n_regionkey"]).alias("is_nation_key"),
    )


@query(
    "primary_key_columns",
    f"""
    SELECT table_name, unnest(columns) AS column_name, CAST(generate_subscripts(columns, 1) AS INTEGER) AS ordinal_position
    FROM ({_UNIQUE_SQL}) WHERE is_unique AND constraint_name NOT LIKE '%name'
    """,
)
def primary_keys(t: Tables) -> DataFrame:
    return _primary_keys(t)


def _primary_keys(t: Tables) -> DataFrame:
    found = _constraints(t)
    kind = F.when(F.col("is_unique") & ~F.col("constraint_name").endswith("name"), F.lit("PRIMARY KEY")).otherwise(F.lit("UNIQUE"))
    constraints = found.select("table_name", "constraint_name", kind.alias("constraint_type"))
    usage = found.select("table_name", "constraint_name", F.posexplode("key").alias("n", "position")).join(
        _declared(t).select("table_name", "position", "column_name"), ["table_name", "position"]
    )
    usage = usage.select("table_name", "constraint_name", "column_name", (F.col("n") + 1).alias("ordinal_position"))
    return primary_key_columns(constraints, usage)


@query(
    "table_metadata",
    f"""
    WITH pk AS (SELECT table_name, unnest(columns) AS column_name, CAST(generate_subscripts(columns, 1) AS INTEGER) AS key_position
                FROM ({_UNIQUE_SQL}) WHERE is_unique AND constraint_name NOT LIKE '%name'),
    cols(table_name, column_name, data_type, target_type, position) AS (VALUES
        ('customer', 'c_custkey', 'BIGINT', 'BIGINT', 1), ('customer', 'c_name', 'TEXT', 'TEXT', 2), ('customer', 'c_nationkey', 'INTEGER', 'INTEGER', 3),
        ('customer', 'c_acctbal', 'DOUBLE', 'DOUBLE PRECISION', 4), ('customer', 'c_mktsegment', 'TEXT', 'TEXT', 5),
        ('supplier', 's_suppkey', 'BIGINT', 'BIGINT', 1), ('supplier', 's_name', 'TEXT', 'TEXT', 2), ('supplier', 's_nationkey', 'INTEGER', 'INTEGER', 3),
        ('supplier', 's_acctbal', 'DOUBLE', 'DOUBLE PRECISION', 4),
        ('nation', 'n_nationkey', 'INTEGER', 'INTEGER', 1), ('nation', 'n_name', 'TEXT', 'TEXT', 2), ('nation', 'n_regionkey', 'INTEGER', 'INTEGER', 3)),
    n AS (SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation)
    SELECT c.table_name, c.column_name, c.data_type, c.target_type, c.position, pk.key_position, n.row_count
    FROM cols c JOIN n ON n.table_name = c.table_name LEFT JOIN pk ON pk.table_name = c.table_name AND pk.column_name = c.column_name
    """,
)
def metadata_of_tables(t: Tables) -> DataFrame:
    tables = {"customer": t.customer, "supplier": t.supplier, "nation": t.nation}
    return table_metadata(catalog(t.spark, tables), table_statistics(tables), _primary_keys(t))


@query(
    "property_diff",
    f"""
    WITH u AS ({_UNIQUE_SQL})
    SELECT table_name, 'primary_key_changed' AS change FROM u
    WHERE constraint_name IN ('orders_key', 'line_key', 'supplier_key') AND NOT is_unique
    """,
)
def declared_against_found(t: Tables) -> DataFrame:
    """Declared primary keys against those the data keeps."""
    found = _constraints(t).where("constraint_name IN ('orders_key', 'line_key', 'supplier_key')")

    def properties(key: F.Column) -> DataFrame:
        blank = F.lit(None).cast("string")
        return found.select(
            "table_name", key.alias("primary_key"), F.lit(0).alias("foreign_keys"), blank.alias("comment"), blank.alias("clustering_key")
        )

    kept = F.when(F.col("is_unique"), F.col("key")).otherwise(F.array().cast("array<int>"))
    return property_diff(properties(F.col("key")), properties(kept)).select("table_name", "change")


# ---- type and layout advice -------------------------------------------------------------


def _int_advice(column: str, source: str, table: str) -> str:
    steps = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
    keep = {"bigint": 3, "int": 2, "smallint": 1}[source]
    cases = " ".join(f"WHEN min({column}) >= {lo} AND max({column}) <= {hi} THEN '{name}'" for name, lo, hi in steps[:keep])
    return (
        f"SELECT '{column}' AS \"column\", '{source}' AS from_type, CASE {cases} END AS to_type, 'int_downcast' AS rule, "
        f"greatest(abs(CAST(min({column}) AS DOUBLE)), abs(CAST(max({column}) AS DOUBLE))) AS metric FROM {table}"
    )


def _text_advice(column: str, table: str) -> str:
    return (
        f"SELECT '{column}', 'string', CASE WHEN count(DISTINCT {column}) / count(*) < 0.5 THEN 'category' END, 'category', "
        f"count(DISTINCT {column}) / count(*) FROM {table}"
    )


def _float_advice(column: str, table: str) -> str:
    return (
        f"SELECT '{column}', 'double', CASE WHEN max(abs({column})) < 3.4e38 THEN 'float' END, 'float_downcast', max(abs({column})) FROM {table}"
    )


_LINE_ADVICE = " UNION ALL ".join(
    [_int_advice(c, "bigint", "lineitem") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    + [_int_advice("l_linenumber", "int", "lineitem")]
    + [_text_advice(c, "lineitem") for c in ("l_returnflag", "l_linestatus")]
)
_ORDER_ADVICE = " UNION ALL ".join(
    [_int_advice(c, "bigint", "orders") for c in ("o_orderkey", "o_custkey")]
    + [_float_advice("o_totalprice", "orders")]
    + [_text_advice(c, "orders") for c in ("o_orderstatus", "o_orderpriority")]
)
_PART_ADVICE = " UNION ALL ".join(
    [_int_advice("p_partkey", "bigint", "part"), _int_advice("p_size", "int", "part")]
    + [_text_advice(c, "part") for c in ("p_name", "p_brand", "p_type")]
)


@query("advise_types_lineitem", f"SELECT * FROM ({_LINE_ADVICE}) WHERE to_type IS NOT NULL")
def advise_types_lineitem(t: Tables) -> DataFrame:
    return advise_types(t.lineitem)


@query("advise_types_aggressive", f"SELECT * FROM ({_ORDER_ADVICE}) WHERE to_type IS NOT NULL")
def advise_types_aggressive(t: Tables) -> DataFrame:
    return advise_types(t.orders, aggressive=True)


@query(
    "dictionary_columns",
    """
    SELECT "column", reason FROM (
        SELECT 'p_name' AS "column", count(DISTINCT p_name) / count(*) AS s, 'low_cardinality' AS reason FROM part
        UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) / count(*), 'low_cardinality' FROM part
        UNION ALL SELECT 'p_type', count(DISTINCT p_type) / count(*), 'low_cardinality' FROM part) WHERE s < 0.5
    UNION ALL SELECT 'p_size', 'smallint' UNION ALL SELECT 'is_large', 'boolean'
    """,
)
def dictionary_advice(t: Tables) -> DataFrame:
    part = t.part.withColumns({"p_size": F.col("p_size").cast("smallint"), "is_large": F.col("p_size") > 25})
    return dictionary_columns(part)


@query(
    "type_reduction",
    f"""
    WITH w(t, b) AS (VALUES ('tinyint', 1), ('smallint', 2), ('int', 4), ('bigint', 8), ('double', 8), ('string', 16), ('category', 4)),
    cols(c, t) AS (VALUES ('p_partkey', 'bigint'), ('p_name', 'string'), ('p_brand', 'string'), ('p_type', 'string'), ('p_size', 'int'), ('p_retailprice', 'double')),
    s AS (SELECT old.b AS b0, coalesce(nw.b, old.b) AS b1, a.to_type FROM cols
          JOIN w old ON old.t = cols.t LEFT JOIN (SELECT * FROM ({_PART_ADVICE}) WHERE to_type IS NOT NULL) a ON a."column" = cols.c
          LEFT JOIN w nw ON nw.t = a.to_type)
    SELECT CAST(sum(b0) AS BIGINT) AS bytes_before, CAST(sum(b1) AS BIGINT) AS bytes_after,
           CAST(round((sum(b0) - sum(b1)) * 100.0 / sum(b0), 2) AS DOUBLE) AS reduction_pct, count(to_type) AS columns_changed FROM s
    """,
)
def type_reduction(t: Tables) -> DataFrame:
    estimate = reduction(t.part, advise_types(t.part))
    return estimate.withColumn("reduction_pct", F.col("reduction_pct").cast("double"))


# ---- reports ----------------------------------------------------------------------------


@query(
    "delivery_listing",
    """
    WITH results AS (
        SELECT 'orders' AS table_name, 'incremental' AS sync_mode, count(*) AS total_rows FROM orders
        UNION ALL SELECT 'customer', NULL, count(*) FROM customer
        UNION ALL SELECT 'events', NULL, count(*) FROM events),
    specs AS (SELECT * FROM (VALUES ('orders', 'upsert', 'o_orderkey', 'o_orderdate', 'dw.orders'), ('customer', 'upsert', 'c_custkey', NULL, 'dw.customer')) v(name, sync_mode, merge_keys, watermark_column, target))
    SELECT r.table_name AS name, coalesce(r.sync_mode, s.sync_mode, 'full') AS sync_mode, s.merge_keys, s.watermark_column,
           r.total_rows, CAST(ceil(r.total_rows / 1000.0) AS BIGINT) AS total_chunks, r.table_name AS data_folder, s.target
    FROM results r LEFT JOIN specs s ON r.table_name = s.name
    """,
)
def delivery(t: Tables) -> DataFrame:
    counted = table_statistics({"orders": t.orders, "customer": t.customer, "events": t.events})
    results = counted.select(
        "table_name",
        F.when(F.col("table_name") == "orders", F.lit("incremental")).alias("sync_mode"),
        F.col("row_count").alias("total_rows"),
        F.ceil(F.col("row_count") / 1000).alias("total_chunks"),
        F.lit(None).cast("string").alias("folder_id"),
    )
    specs = t.spark.createDataFrame(
        [("orders", "upsert", "o_orderkey", "o_orderdate", "dw.orders"), ("customer", "upsert", "c_custkey", None, "dw.customer")],
        "name string, sync_mode string, merge_keys string, watermark_column string, target string",
    )
    return delivery_listing(results, specs)


@query(
    "run_summary",
    """
    SELECT CAST(run_day AS VARCHAR) AS run_day, count(*) FILTER (NOT failed) AS tables_processed, count(*) FILTER (failed) AS tables_failed,
           CAST(coalesce(sum(n) FILTER (NOT failed), 0) AS BIGINT) AS total_rows
    FROM (SELECT CAST(ts AS DATE) AS run_day, event_type, event_type = 'error' AS failed, count(*) AS n FROM events GROUP BY ALL)
    GROUP BY run_day
    """,
)
def daily_runs(t: Tables) -> DataFrame:
    log = t.events.select(
        F.to_date("ts").cast("string").alias("run_day"), "event_type", F.lit(1).alias("row_count")
    )
    return run_summary(log, "run_day", "event_type", "row_count", F.col("event_type") == "error")


@query(
    "purpose_text",
    """
    SELECT s_nationkey, count(*) AS tables, s_nationkey || ': ' || CASE WHEN count(*) <= 3
        THEN string_agg(s_name, ', ' ORDER BY s_name) ELSE count(*) || ' tables' END AS purpose
    FROM supplier GROUP BY s_nationkey
    """,
)
def purpose_text(t: Tables) -> DataFrame:
    return purpose_parts(t.supplier, "s_nationkey", "s_name")


@query(
    "run_purpose",
    """
    SELECT string_agg(part, '; ' ORDER BY part) AS purpose FROM (
        SELECT mode || ': ' || CASE WHEN count(*) <= 3 THEN string_agg(s_name, ', ' ORDER BY s_name) ELSE count(*) || ' tables' END AS part
        FROM (SELECT s_name, CASE WHEN s_acctbal > 9700 THEN 'full' WHEN s_acctbal < 0 THEN 'incremental' ELSE 'upsert' END AS mode FROM supplier)
        GROUP BY mode)
    """,
)
def purpose_of_run(t: Tables) -> DataFrame:
    mode = F.when(F.col("s_acctbal") > 9700, F.lit("full")).when(F.col("s_acctbal") < 0, F.lit("incremental")).otherwise(F.lit("upsert"))
    return run_purpose(t.supplier.withColumn("mode", mode), "mode", "s_name")


@query("latest_entries", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def newest_events(t: Tables) -> DataFrame:
    return latest_entries(t.events, 25, [F.desc("ts"), F.desc("event_id")])


@query(
    "history_summary",
    """
    SELECT user_id, count(*) FILTER (event_type <> 'signup') AS total_changes, count(*) FILTER (event_type = 'signup') AS initial_extractions,
           count(*) AS total_entries
    FROM events GROUP BY user_id ORDER BY total_changes DESC, user_id
    """,
)
def changes_per_user(t: Tables) -> DataFrame:
    return history_summary(t.events, ["user_id"], F.col("event_type") == "signup")


@query(
    "history_between",
    """
    SELECT event_id, logged_at FROM (
        SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS logged_at FROM events)
    WHERE TRY_CAST(logged_at AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
    """,
)
def history_in_range(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    log = t.events.select("event_id", text.alias("logged_at"))
    return history_between(log, "logged_at", "2024-01-10", "2024-01-20")


@query(
    "row_count_verification",
    """
    SELECT e.l_returnflag, e.n AS expected_rows, coalesce(a.n, 0) AS actual_rows, e.n = coalesce(a.n, 0) AS matches
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) e
    LEFT JOIN (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity <= 50 AND l_linestatus = 'F' GROUP BY 1) a ON a.l_returnflag = e.l_returnflag
    """,
)
def row_count_verification(t: Tables) -> DataFrame:
    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias(name))

    loaded = totals(t.lineitem.where("l_quantity <= 50 AND l_linestatus = 'F'"), "loaded")
    return match_counts(loaded, totals(t.lineitem, "listed"), "l_returnflag", "loaded", "listed")


@query(
    "advise_from_sketches",
    """
    SELECT 'p_brand' AS "column", count(DISTINCT p_brand) / count(*) < 0.5 AS is_category FROM part
    UNION ALL SELECT 'p_name', count(DISTINCT p_name) / count(*) < 0.5 FROM part
    UNION ALL SELECT 'p_type', count(DISTINCT p_type) / count(*) < 0.5 FROM part
    UNION ALL SELECT 'half', count(DISTINCT p_partkey // 2) / count(*) < 0.5 FROM part
    """,
)
def advise_from_sketches(t: Tables) -> DataFrame:
    """Sketches by slice of the parts, united; a column at the very threshold is recounted."""
    part = t.part.select("p_name", "p_brand", "p_type", F.expr("CAST(p_partkey div 2 AS STRING)").alias("half"), "p_partkey")
    slices = column_sketches(part, F.expr("CAST(p_partkey % 7 AS STRING)"))
    return category_columns(slices, part).select("column", "is_category")
