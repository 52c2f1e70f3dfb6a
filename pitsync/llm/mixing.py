"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.llm.running import running
from pitsync.llm.staging import stage

#: Fixed value: what separates words.
SPACES = r"[\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from rows with ``source`` and ``size``.

    Sources by code point, NULL last, take ``weights`` in turn and share ``share`` times all
    sizes by them. No target is above ``most`` times its source's size: what is left over
    goes to the others by weight, in rounds, until none is above. A round is one
    aggregation; two numbers come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = running(totals, [], [F.col("source").asc_nulls_last()], label="mix-sources")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    sources = stage(numbered.select("source", "source_size", turn.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap")), "mix-weights")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    above, known, given = F.lit(False), -1, None
    while True:
        capped, rest, weight = sources.agg(F.count_if(above), F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if capped == known or not weight:
            break
        known, given = capped, (budget - rest, weight)
        above = above | (F.col("weight") * (F.lit(float(given[0])) / F.lit(given[1])) > F.col("cap"))
    share_of = F.col("cap") if given is None else F.when(above, F.col("cap")).otherwise(F.col("weight") * (F.lit(float(given[0])) / F.lit(given[1])))
    return sources.select("source", "source_size", share_of.cast("double").alias("target"))


def schedule(sizes: DataFrame, targets: DataFrame, share: float, times: int, seed: int) -> DataFrame:
    """Copies of documents in the order of the mix: row_no, copy, size, finish, before.

    Every source is a queue: all its documents, shuffled, then all again in another
    order, ``times`` in all. A copy's virtual finish time is the number of its queue's words
    up to its end over the target of its source. All queues are merged by finish time.
    ``before`` is the number of words ahead of a copy in the mix; the mix is the copies
    that end within its budget.
    """
    copies = sizes.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    place = F.sha2(F.concat_ws(":", F.lit(seed), "copy", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "hash"), 256)
    queued = running(copies.withColumn("place", place), ["source"], ["copy", "place"], F.col("size"), "mix-queues")
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    timed = queued.join(t, F.col("source").eqNullSafe(F.col("t_source"))).withColumn(
        "finish", F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target")).otherwise(0.0)
    )
    columns = ["row_no", "doc_id", "copy", "source", "size", "source_size", "target", "place", "finish"]
    return running(timed.select(*columns), [], ["finish", F.col("source").asc_nulls_last(), "copy", "place"], F.col("size"), "mix-order")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    The mix holds whole documents, each up to ``most`` times, and ends with the last copy
    within ``share`` times all words. At that point the queues stand at one virtual time,
    so a source's words are near its target: a queue lacks less than the document it was at.

    A NULL text has size 0, a NULL source is the last source. Documents of size 0 are
    never taken from, nor are sources without words, whose target is 0. The order depends
    on ids, texts and ``seed`` alone, so reruns agree; rows that repeat an id and text
    take the places of each other. An empty table gives an empty result; other columns
    are not looked at.
    """
    sizes = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), "source",
        word_count(F.col("text")).alias("size"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"),
    )
    sizes = stage(sizes, "mix-sizes")
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets")
    order = schedule(sizes, targets, share, most, seed)
    within = F.col("before") + F.col("size") <= F.floor(F.col("total") / most * share)
    taken = F.sum(F.when(within, F.col("size")).otherwise(0)).cast("long").alias("taken")
    return order.groupBy("row_no", "doc_id", "size", "source_size", "target").agg(taken).drop("row_no")
