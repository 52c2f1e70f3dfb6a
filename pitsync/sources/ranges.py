"""Tables kept in key ranges under a two-level tree of digests, so that equal ranges are left alone.

A range holds the keys whose SHA-256 begins with the same hex digits, so ranges are even
whatever the keys are, and new keys need no new bounds. A leaf of the tree is the
order-free digest of a range's rows; a node of the upper level is a hash of the leaves
that share a first digit. Trees are compared from the top: equal nodes end the search,
and only the ranges of leaves that differ are read on, sorted and written.

    root/data/leaf=..   the rows
    root/tree           leaf, rows, digest, version
    root/log            one row per change, written last
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitsync.functions.hashing import multiset_digest, row_words
from pitsync.functions.names import require
from pitsync.sources.sinks import LayoutSpec, append_rows, claim, read_log, write_layout

LEAF = "leaf"
TREE = "leaf string, rows long, digest string, version long"
LOG = "version long, run_id string, keys string, digits int, schema string, ranges long, written long, deleted long, rows_written long"


def leaf_of(keys: Sequence[str], digits: int) -> Column:
    """The range of a row: the first hex digits of a hash of its keys."""
    texts = [F.coalesce(F.concat(F.length(k).cast("string"), F.lit(":"), k), F.lit("-")) for k in (F.col(c).cast("string") for c in keys)]
    return F.substring(F.sha2(F.concat_ws("|", *texts), 256), 1, digits)


def range_digests(df: DataFrame, keys: Sequence[str], digits: int) -> DataFrame:
    """(leaf, rows, digest): rows are hashed where they lie, sums meet in one small shuffle."""
    one, two = row_words(df.schema)
    hashed = df.select(leaf_of(keys, digits).alias(LEAF), one.alias("__one"), two.alias("__two"))
    return hashed.groupBy(LEAF).agg(F.count(F.lit(1)).alias("rows"), multiset_digest([F.col("__one"), F.col("__two")]).alias("digest"))


def compare_trees(old: DataFrame, new: DataFrame) -> DataFrame:
    """(leaf, status) of the ranges that are new, changed or deleted, found from the top down."""

    def tops(tree: DataFrame, name: str) -> DataFrame:
        leaves = F.sort_array(F.collect_list(F.concat_ws(":", LEAF, "digest")))
        return tree.groupBy(F.substring(LEAF, 1, 1).alias("top")).agg(F.sha2(F.concat_ws(",", leaves), 256).alias(name))

    differ = tops(old, "o").join(tops(new, "n"), "top", "full_outer").where(~F.col("o").eqNullSafe(F.col("n"))).select("top")
    below = [t.where(F.col(LEAF).isNotNull()).join(differ, F.substring(LEAF, 1, 1) == F.col("top"), "left_semi").select(LEAF, F.col("digest").alias(n)) for t, n in ((old, "o"), (new, "n"))]
    both = below[0].join(below[1], LEAF, "full_outer").where(~F.col("o").eqNullSafe(F.col("n")))
    return both.select(LEAF, F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "deleted").otherwise("changed").alias("status"))


@dataclass(frozen=True)
class RangeTable:
    """Rows in key ranges below one root, with the tree that describes them."""

    spark: SparkSession
    root: str

    def head(self) -> Any | None:
        """The log row of the last change."""
        return read_log(self.spark, f"{self.root}/log", LOG).orderBy(F.desc("version")).limit(1).first()

    def tree(self) -> DataFrame:
        """(leaf, rows, digest) as of the last change; empty before the first."""
        head = self.head()
        trees = read_log(self.spark, f"{self.root}/tree", TREE)
        return trees.where(F.col("version") == (head["version"] if head else 0)).drop("version")

    def read(self) -> DataFrame:
        """The rows of all ranges. Ranges that the tree no longer has are not read, though
        their files may still be there."""
        return self.placed(self.tree()).drop(LEAF)

    def placed(self, leaves: DataFrame) -> DataFrame:
        """The rows of the ranges listed, with their ``leaf`` last."""
        head = self.head()
        schema = T.StructType.fromJson(json.loads(head["schema"])).add(LEAF, T.StringType())
        if not head["ranges"]:
            return self.spark.createDataFrame([], schema)
        data = self.spark.read.schema(schema).parquet(f"{self.root}/data")
        # at most 16 ** digits short texts
        return data.join(F.broadcast(leaves.select(LEAF)), LEAF, "left_semi").select(*schema.names)

    def update(self, df: DataFrame, keys: Sequence[str], run_id: str, digits: int = 2, layout: LayoutSpec = LayoutSpec()) -> dict[str, int]:
        """Make the table hold ``df``; ranges whose rows are as before are not written.

        ``df`` is read once for the digests, and once more, filtered, where ranges differ.
        There are 16 ** ``digits`` ranges, at most 65,536; their number and the keys stay.
        """
        if not 1 <= digits <= 4:
            raise ValueError("digits is 1 to 4")
        keys = [require(df, k) for k in keys]
        # the hash of the keys is taken once a row, below the join
        placed = df.withColumn(LEAF, leaf_of(keys, digits))

        def rows(touched: DataFrame) -> DataFrame:
            return placed.join(F.broadcast(touched), LEAF, "left_semi").select(*placed.columns)

        return self._become(range_digests(df, keys, digits), rows, df.schema, keys, digits, run_id, layout)

    def pull(self, source: RangeTable, run_id: str, layout: LayoutSpec = LayoutSpec()) -> dict[str, int]:
        """Make the table hold what ``source`` does: trees are compared, and only ranges that
        differ are read from the source. Its files hold a range each, so they are written on
        as they are read, without a shuffle."""
        head = source.head()
        if head is None:
            raise ValueError(f"{source.root} holds nothing yet")
        schema = T.StructType.fromJson(json.loads(head["schema"]))
        layout = replace(layout, lie_together=True)
        return self._become(source.tree(), source.placed, schema, json.loads(head["keys"]), head["digits"], run_id, layout)

    def _become(
        self, tree: DataFrame, rows: Callable[[DataFrame], DataFrame], schema: T.StructType, keys: Sequence[str], digits: int, run_id: str, layout: LayoutSpec
    ) -> dict[str, int]:
        head = self.head()
        if head is not None and (json.loads(head["keys"]), head["digits"]) != (list(keys), digits):
            raise ValueError(f"{self.root} has ranges of {head['keys']} by {head['digits']} digits")
        stage, same_schema = f"{self.root}/next", head is not None and head["schema"] == schema.json()
        write_layout(tree.select(LEAF, "rows", "digest"), f"{stage}/tree", LayoutSpec(), "overwrite")
        new = self.spark.read.schema(TREE).parquet(f"{stage}/tree").drop("version")
        # other columns or types: every range is written anew
        old = self.tree() if same_schema else self.tree().withColumn("digest", F.lit(""))
        write_layout(compare_trees(old, new), f"{stage}/status", LayoutSpec(), "overwrite")
        status = self.spark.read.schema("leaf string, status string").parquet(f"{stage}/status")
        counts = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}
        written, deleted = counts.get("new", 0) + counts.get("changed", 0), counts.get("deleted", 0)
        total = new.count()
        result = {"ranges": total, "written": written, "deleted": deleted, "rows_written": 0}
        if head is not None and same_schema and not written and not deleted:
            return result
        version = 1 if head is None else head["version"] + 1
        claim(self.spark, f"{self.root}/versions", version)
        if written:
            touched = status.where("status <> 'deleted'").select(LEAF)
            by_leaf = replace(layout, partition_by=(LEAF,))
            seen = write_layout(rows(touched), f"{self.root}/data", by_leaf, "overwrite", "dynamic", [F.count(F.lit(1)).alias("rows")])
            result["rows_written"] = seen["rows"]
        new.withColumn("version", F.lit(version).cast("long")).coalesce(1).write.mode("append").parquet(f"{self.root}/tree")
        row = (version, run_id, json.dumps(list(keys)), digits, schema.json(), total, written, deleted, result["rows_written"])
        append_rows(self.spark, f"{self.root}/log", LOG, [row])
        return result
