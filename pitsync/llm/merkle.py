"""A Merkle manifest of a dataset, verified leaf by leaf with a recursive query."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.llm.ascii import lower_ascii
from pitsync.llm.running import running
from pitsync.llm.staging import stage

#: Fixed value: how many consecutive nodes become one.
FAN = 8
#: Up to so many runs below a node read the same copy of it.
_READERS = 64
#: The number of the tree above the trees of all groups.
_TOP = -1
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def field(value: Column) -> Column:
    """A value as the leaves hash it: bytes, colon, text; NULL as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def document_leaf(text: Column) -> Column:
    """The leaf of a row of ``documents`` with ``text`` as its text."""
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


@dataclass(frozen=True)
class Manifest:
    """The stored tree.

    ``runs``: the lowest nodes, one row for up to eight leaves: (tree, pos, n, members,
    digest, and the link to the parent: up_tree, up_level, up_pos, up_copies, slot).
    ``members`` are the leaves in order, with what came along with them. ``nodes``: all nodes
    above leaves, linked in the same way, with the digests of their children. The path of
    every leaf meets at the root, so a node is stored in copies, numbered by ``part``: one
    for about 64 runs below it, which adds a row for 64 runs and level.
    """

    runs: DataFrame
    nodes: DataFrame


def _hash_run(children: str) -> Column:
    return F.expr(f"unhex(sha2(array_join(transform({children}, x -> lower(hex(x))), ''), 256))")


def _levels(items: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``items`` (tree, pos, n, digest), and the last node of every tree.

    ``n`` is the number of nodes of the tree on that level; trees end where it is 1.
    """
    left = items.agg(F.max("n")).first()[0] or 0
    levels, tops = [], [items.where("n = 1")]
    while left > 1:
        left = -(-left // FAN)
        grouped = items.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("pos"))
        level = grouped.agg(
            F.expr(f"(max(n) + {FAN - 1}) div {FAN}").alias("n"),
            F.expr("sort_array(collect_list(struct(pos, digest))).digest").alias("children"),
        )
        items = stage(level.withColumn("digest", _hash_run("children")), "merkle-level")
        levels.append(items.withColumn("level", F.lit(len(levels) + 1).cast("long")))
        tops.append(items.where("n = 1"))
    columns = ("tree", "digest")
    return levels, functools.reduce(DataFrame.union, [t.select(*columns) for t in tops])


def _copies(tree: Column | int, level: Column | int, depth: int, most: int) -> Column:
    """How many copies a node has: the runs that can lie below it over ``_READERS``."""
    level = F.lit(level) if isinstance(level, int) else level
    steps = level + F.when(F.lit(tree) == _TOP if isinstance(tree, int) else tree == _TOP, depth).otherwise(0)
    below = F.pow(F.lit(float(FAN)), steps - 1)
    return F.greatest(F.lit(1), F.least(F.ceil(below / _READERS), F.lit(most))).cast("long")


def _linked(nodes: DataFrame, level: Column | str, tops: DataFrame, depth: int, most: int) -> DataFrame:
    """``nodes`` with the parent of each: in their tree, or of a last node in the top tree."""
    up = ("up_tree", "up_level", "up_pos", "slot", "up_copies")
    level = F.col(level) if isinstance(level, str) else level
    inner = nodes.where("n > 1").select(
        "*",
        F.col("tree").alias(up[0]),
        (level + 1).alias(up[1]),
        F.expr(f"pos div {FAN}").alias(up[2]),
        F.expr(f"pos % {FAN}").alias(up[3]),
        _copies(F.col("tree"), level + 1, depth, most).alias(up[4]),
    )
    last = nodes.where("n = 1").join(tops.withColumnRenamed("tree", "__tree"), F.col("tree") == F.col("__tree"), "left")
    outer = last.select(
        *nodes.columns,
        F.when(F.col("many"), F.lit(_TOP).cast("long")).alias(up[0]),
        F.lit(1).cast("long").alias(up[1]),
        F.expr(f"at div {FAN}").alias(up[2]),
        F.expr(f"at % {FAN}").alias(up[3]),
        _copies(_TOP, 1, depth, most).alias(up[4]),
    )
    return inner.unionByName(outer)


def build(leaves: DataFrame, group: str, order: Sequence[str], keep: Sequence[str] = ()) -> Manifest:
    """The manifest of ``leaves``, which have the bytes of their hash in ``leaf``.

    Leaves of a ``group`` ascend by ``order``, NULLs first; ties follow by their hash. Every
    level is written as its own table, and none passes through one task: groups are
    numbered by a range sort, and a node is an aggregate of its eight children.
    """
    rows = leaves.select(group, *order, "leaf", *[c for c in keep if c not in (group, *order)])
    numbered = running(rows, [group], [*[F.col(c).asc_nulls_first() for c in order], F.col("leaf")], label="merkle-leaves")
    member = F.struct(F.col("before").alias("pos"), F.col("leaf").alias("digest"), *keep)
    runs = numbered.groupBy(F.col("first").alias("tree"), F.expr(f"before div {FAN}").alias("pos")).agg(
        F.max("total").alias("leaves"), F.sort_array(F.collect_list(member)).alias("members")
    )
    # a lone leaf is the subroot itself, so its run is no node but the leaf
    lone = F.col("leaves") == 1
    runs = runs.select(
        "tree", "pos", F.when(lone, 1).otherwise(F.expr(f"(leaves + {FAN - 1}) div {FAN}")).cast("long").alias("n"), "members",
        F.when(lone, F.col("members.digest")[0]).otherwise(_hash_run("members.digest")).alias("digest"),
    )
    runs = stage(runs, "merkle-runs")
    levels, tops = _levels(runs.select("tree", "pos", "n", "digest"))

    ends = running(tops, [], ["tree"], label="merkle-tops")
    ends = stage(ends.select("tree", "digest", F.col("before").alias("at"), F.col("total").alias("n")), "merkle-ends")
    above, _ = _levels(ends.select(F.lit(_TOP).cast("long").alias("tree"), F.col("at").alias("pos"), "n", "digest"))
    tops = ends.select("tree", "at", (F.col("n") > 1).alias("many"))

    empty = runs.select("tree", "pos", "n", F.array("digest").alias("children"), "digest", F.lit(0).cast("long").alias("level")).where("false")
    stored = functools.reduce(DataFrame.unionByName, [*levels, *above], empty)
    depth, most = len(levels), -(-runs.count() // _READERS)
    copies = F.sequence(F.lit(0).cast("long"), _copies(F.col("tree"), F.col("level"), depth, most) - 1)
    nodes = _linked(stored, "level", tops, depth, most).withColumn("part", F.explode(copies))
    return Manifest(_linked(runs, F.lit(0), tops, depth, most), stage(nodes, "merkle-nodes"))


#: A step goes from a node to its parent: it appends the parent's other children to the proof, and hashes
#: all of them anew with what was folded so far in place of the node.
CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree, pos, up_tree, up_level, up_pos, up_copies, slot, folded, CAST('' AS BINARY) AS proof, digest AS subroot, digest AS top
  FROM {runs}
  UNION ALL
  SELECT c.tree, c.pos, n.up_tree, n.up_level, n.up_pos, n.up_copies, n.slot,
    transform(c.folded, f -> unhex(sha2(array_join(transform(n.children, (x, i) -> lower(hex(IF(i = c.slot, f, x)))), ''), 256))),
    concat(c.proof, aggregate(filter(n.children, (x, i) -> i <> c.slot), CAST('' AS BINARY), (a, x) -> concat(a, x))),
    IF(n.tree < 0, c.subroot, n.digest), n.digest
  FROM climb c JOIN {nodes} n
  ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND pmod(c.pos, c.up_copies) = n.part
)
SELECT tree, pos, folded, proof, subroot, top FROM climb WHERE up_tree IS NULL
"""


def verify(manifest: Manifest, now: str) -> DataFrame:
    """One row per leaf: its members, ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded``, as bytes.

    ``now`` names the member with the hash that a leaf has now; folding it with the stored
    siblings up to the root gives ``folded``, which equals ``root`` if nothing changed.
    ``proof`` is the SHA-256 of the siblings. The leaves of a run share their path, so they
    climb as one row: it gathers the shared siblings once, and folds each leaf by itself.
    """
    spark = manifest.runs.sparkSession
    own = F.expr(
        f"transform(members, (m, k) -> IF(size(members) = 1 AND n = 1, m.{now}, unhex(sha2(array_join("
        f"transform(members, (x, i) -> lower(hex(IF(i = k, m.{now}, x.digest)))), ''), 256))))"
    )
    start = manifest.runs.select("tree", "pos", "up_tree", "up_level", "up_pos", "up_copies", "slot", own.alias("folded"), "digest")
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # a step returns a row per run, whatever their number
    try:
        climbed = stage(spark.sql(CLIMB, runs=start, nodes=manifest.nodes), "merkle-climb")
    finally:
        spark.conf.set(_ROW_LIMIT, limit)
    runs = manifest.runs.select(F.col("tree").alias("t"), F.col("pos").alias("p"), "members")
    paired = climbed.join(runs, (F.col("tree") == F.col("t")) & (F.col("pos") == F.col("p")))
    single = paired.select("subroot", "top", "proof", "folded", "members", F.posexplode("members").alias("at", "member"))
    beside = F.expr("array_join(transform(filter(members, (x, i) -> i <> at), x -> lower(hex(x.digest))), '')")
    return single.select(
        "member.*",
        F.col("member.digest").alias("leaf"),
        "subroot",
        F.col("top").alias("root"),
        digest(beside, F.lower(F.hex("proof"))).alias("proof"),
        F.col("folded")[F.col("at")].alias("folded_root"),
    )


def tampered(doc_id: Column, text: Column, every: int = 3) -> Column:
    """``text`` after tampering: its A-Z in lower case where ``every`` divides the crc32 of the id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % every == 0
    return F.when(hit, lower_ascii(text)).otherwise(text)


def audit_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The tree holds the documents as they are; what is verified is a tampered copy (see
    ``tampered``). Hashes are lowercase hex. NULLs in any column are hashed as such and a
    NULL lang is a group of its own, the first; NULL ids come first in their group and are
    never tampered with. Empty and NULL texts differ. Rows repeated with one doc_id are
    leaves each, ordered by their hash. A single leaf or group is its own subroot or
    root. An empty table gives an empty result; other columns are not looked at.
    """
    text = F.col("text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select("doc_id", "lang", document_leaf(text).alias("leaf"), F.when(hit, document_leaf(tampered(F.col("doc_id"), text))).alias("other"))
    rows = stage(rows.select("doc_id", "lang", "leaf", F.coalesce("other", "leaf").alias("now")), "merkle-hashes")
    checked = verify(build(rows, "lang", ["doc_id"], keep=["doc_id", "now"]), "now")
    shown = [F.lower(F.hex(c)).alias(name) for c, name in (("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("proof", "proof_sha256"), ("folded_root", "folded_root"))]
    return checked.select("doc_id", *shown, (F.col("folded_root") == F.col("root")).alias("verified"))
