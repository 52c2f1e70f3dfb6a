"""Benchmark decontamination by SimHash of item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.llm.staging import stage, unused

#: Bits of a fingerprint, and the counters that are summed side by side in a long.
BITS, LANES = 64, "281479271743489L"


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; null and empty texts have none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def _shingles(hashes: str, width: int) -> Column:
    """The hash of each run of ``width`` words, in order, repeated ones too."""
    run = ", ".join(f"{hashes}[i + {k}]" for k in range(width))
    return F.expr(
        f"CASE WHEN size({hashes}) < {width} THEN array() ELSE "
        f"transform(sequence(0, size({hashes}) - {width}), i -> xxhash64({run})) END"
    ).cast("array<long>")


def _fingerprint(shingles: str) -> Column:
    """SimHash: bit b is set if most elements set it.

    Lane j of the k-th sum counts bit k + 16 j, so one pass of a shift, a mask and an
    addition per shingle counts four bits.
    """
    sums = (
        f"transform(sequence(0, 15), k -> aggregate({shingles}, 0L, "
        f"(a, h) -> a + (shiftrightunsigned(h, k) & {LANES})))"
    )
    half = f"size({shingles})"
    lanes = " | ".join(
        f"IF(2 * (shiftrightunsigned(s, {16 * j}) & 65535) > {half}, shiftleft(1L, {16 * j}), 0L)" for j in range(4)
    )
    return F.expr(f"aggregate(zip_with({sums}, sequence(0, 15), (s, k) -> shiftleft({lanes}, k)), 0L, (a, x) -> a | x)")


def _blocks(print_: str, radius: int) -> str:
    """``radius + 1`` blocks: two fingerprints within the radius agree on one at least."""
    n = radius + 1
    low, high = f"cast((nth * {BITS}) div {n} as int)", f"cast(((nth + 1) * {BITS}) div {n} as int)"
    return (
        f"transform(sequence(0, {radius}), nth -> "
        f"shiftrightunsigned({print_}, {low}) & (shiftleft(1L, {high} - {low}) - 1))"
    )


def _numbered(shingles: str) -> Column:
    """The bag as a set: the k-th occurrence of a shingle, from the second on, gets a hash of its own.

    The intersection of two such sets is that of the bags, and no shingle weighs more
    than one element in a fingerprint.
    """
    kth = f"size(filter(slice({shingles}, 1, i + 1), y -> y = x))"
    return F.expr(
        f"CASE WHEN size(array_distinct({shingles})) = size({shingles}) THEN {shingles} "
        f"ELSE transform({shingles}, (x, i) -> CASE WHEN {kth} = 1 THEN x ELSE xxhash64(x, {kth}) END) END"
    )


def _windows(docs: DataFrame, seeds: DataFrame, width: int, broadcast_rows: int) -> DataFrame:
    """(doc_id, text_key, start, n, win): item-sized windows that start at a shared shingle.

    Seeds up to ``broadcast_rows`` are broadcast, and the window is cut from its document
    while it streams by. More are joined by a shuffle of (document, position, hash), and
    the documents that have hits are joined again to cut the windows.
    """
    # explode_outer: the filter that Spark derives from an explode would be pushed into the
    # shingling and repeat the splitting of the text for every word of it
    hashed = docs.select("doc_id", "text_key", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    hashed = hashed.select("doc_id", "text_key", _shingles("hashes", width).alias("sh"))
    if seeds.count() <= broadcast_rows:
        spread = hashed.select("doc_id", "text_key", "sh", F.posexplode_outer("sh").alias("start", "seed"))
        hits = spread.join(F.broadcast(seeds), "seed")
    else:
        spread = hashed.select("doc_id", "text_key", F.posexplode_outer("sh").alias("start", "seed"))
        found = spread.join(seeds, "seed").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "start", "n")
        # repeated rows of a document find the same windows
        found = stage(found.distinct(), "hits")
        same = hashed["doc_id"].eqNullSafe(F.col("d")) & (hashed["text_key"] == F.col("t"))
        hits = hashed.join(found, same)
    # written, so that what is asked of a window is not evaluated for each word of a text
    cut = hits.select("doc_id", "text_key", "start", "n", F.expr("slice(sh, start + 1, n)").alias("win"))
    return stage(cut.withColumn("win", _numbered("win")), "windows")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    radius: int = 24,
    percent: int = 75,
    shingle: int = 5,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, text_key, item_id, similarity, start, n_shingles.

    A window as long as the item slides over the words of the document; at the end of the
    document it is cut short. Its fingerprint is looked up in an index of the items of
    that length, by ``radius + 1`` blocks of bits, which finds every item within
    ``radius``. Candidates are kept if the similarity of the two bags of shingles, each
    weighing as often as it occurs, is ``percent`` or more. A fingerprint is taken of
    shingles numbered by occurrence, so that one that is repeated does not move all bits
    and the distance follows the similarity of the bags. Per document and item, the best
    window counts, the first one of equals.

    Windows that start at a shingle which the item does not have are passed over: the one
    from its first shared shingle on has at least the same similarity.

    An item of fewer words than ``shingle`` is one shingle of its own length. Items and
    documents without words match nothing, null texts count as empty. Documents without
    doc_id are reported with a null; ``text_key`` is a hash of the text that tells rows of
    one doc_id apart. Repeated rows give one result row.
    """
    items = benchmark.select(F.col("item_id").alias("item_id"), words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(shingle)))
    items = items.select("item_id", "width", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        words(F.col("text")).alias("words"),
    )
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most `shingle` values
    found = None
    for width in widths or [shingle]:
        own = items.where(F.col("width") == width).select("item_id", _shingles("hashes", width).alias("item"))
        own = own.select("item_id", F.col("item").alias("seeds"), F.size("item").alias("n"), _numbered("item").alias("item"))
        own = stage(own.withColumn("item_print", _fingerprint("item")), "items")
        seeds = own.select(F.explode_outer("seeds").alias("seed"), "n").distinct()
        index = own.select("item_id", "item", "n", "item_print", F.posexplode_outer(F.expr(_blocks("item_print", radius))).alias("block", "bits"))
        index = index.withColumnRenamed("n", "m").withColumnsRenamed({"block": "item_block", "bits": "item_bits"})
        if own.count() * (radius + 1) <= broadcast_rows:
            index = F.broadcast(index)
        windows = _windows(text, seeds, width, broadcast_rows).withColumn("print", _fingerprint("win"))
        probes = windows.select("*", F.posexplode_outer(F.expr(_blocks("print", radius))).alias("block", "bits"))
        near = probes.join(
            index,
            (F.col("n") == F.col("m")) & (F.col("block") == F.col("item_block")) & (F.col("bits") == F.col("item_bits")),
        )
        # a pair that agrees on several blocks counts in the first of them; the distance,
        # which is cheap, is asked first
        within = F.expr(f"coalesce(bit_count(print ^ item_print), {BITS + 1}) <= {radius}")
        first = F.expr(
            f"array_position(zip_with({_blocks('print', radius)}, {_blocks('item_print', radius)}, (x, y) -> x = y), true) - 1"
        )
        near = near.where(within & (F.col("block") == first)).withColumn("shared", F.size(F.array_intersect("win", "item")))
        union = F.size("win") + F.size("item") - F.col("shared")
        near = near.where(F.col("shared") * 100 >= union * percent).select(
            "doc_id", "text_key", "item_id", (F.col("shared") / union).alias("similarity"), "start", F.col("n").alias("n_shingles")
        )
        found = near if found is None else found.unionByName(near)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_shingles")).alias("best")
    return (
        found.groupBy("doc_id", "text_key", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "text_key",
            "item_id",
            "best.similarity",
            (-F.col("best.back")).cast("long").alias("start"),
            F.col("best.n_shingles").cast("long").alias("n_shingles"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    bad_id, bad_key = unused("bad_id", docs), unused("bad_key", docs)
    bad = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(bad_id)) & (key == F.col(bad_key)), "left_anti")
