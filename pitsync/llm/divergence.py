"""How far the sources of a language lie apart in the words they use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitsync.llm.staging import stage
from pitsync.session import work_dir

#: Fixed value: bytes of UTF-8 between terms, all of ASCII but its letters, become blanks; A-Z become a-z.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(128)) + bytes(range(128, 256))
#: Between lang and term in the vocabulary; no term holds it.
_MARK = "\0"
_MAX_INT = 2**31 - 1
#: Bytes of text that a task counts at once, or those of one longer text.
HELD = 4_000_000
#: Counts that a task adds up at once; half of them leave it.
ADDED = 2_000_000
#: Terms in a list of the fit at most: CountVectorizer hashes a list whole, which takes more for each term of a long one.
LISTED = 1000
#: Fixed measure: shares are parts of 10^9, with 2 added to each count. Decimals keep any 64-bit counts exact.
_SHARE = "1 + (CAST({count} + 2 AS DECIMAL(20, 0)) * 1000000000BD) div CAST({n} + 2 * {v} AS DECIMAL(20, 0))"


def terms(texts: list[bytes]) -> tuple[np.ndarray, pa.StringArray]:
    """The terms of texts in UTF-8 in order, with A-Z in lower case, and the number of the text of each."""
    ends = np.cumsum([len(text) + 1 for text in texts])
    letters = np.frombuffer(b" ".join([*texts, b""]).translate(_TERM_BYTES), np.uint8)
    inside = np.zeros(len(letters) + 2, bool)
    inside[1:-1] = letters != 32
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, lengths = turns[::2], turns[1::2] - turns[::2]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(letters[inside[1:-1]]))
    return np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begin, ends), prepend=0)), found


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, rising, and how often each is there; a sort takes less time than numpy's own way."""
    values = np.sort(values)
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.diff(np.append(first, len(values)))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in runs of whole texts of at most ``HELD`` bytes, or one longer text, with these texts."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + HELD, side="right")))
            part = batch.slice(begin, stop - begin)
            yield part, part.column("text").cast(pa.binary()).to_pylist()
            begin = stop


def _added(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """The tables with the ``n`` of equal rows added up, as far as a task can hold them."""
    held, rows = [], 0
    for table in tables:
        held.append(table)
        rows += len(table)
        if rows >= ADDED:
            table = _sum(held)
            held, rows = [table], len(table)
            if rows >= ADDED // 2:
                yield table
                held, rows = [], 0
    if held:
        yield _sum(held)


def _sum(tables: list[pa.Table]) -> pa.Table:
    names = tables[0].column_names
    return pa.concat_tables(tables).group_by(names[:-1], use_threads=False).aggregate([("n", "sum")]).rename_columns(names)


def _lists(keys: np.ndarray, marked: pa.Array, most: int = _MAX_INT) -> tuple[np.ndarray, pa.ListArray]:
    """Terms in lists of one value of ``keys`` each, of at most ``most`` terms, and where a key of each list is."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    more = -(-np.diff(np.append(first, len(order))) // most)
    first = np.repeat(first, more) + most * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))
    return order[first], pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), marked.take(pa.array(order)))


def _documents(part: pa.RecordBatch, texts: list[bytes]) -> pa.Table:
    """(term, n): how many of the documents of a lang have the term; its lang is in front."""
    of_text, found = terms(texts)
    coded, langs = found.dictionary_encode(), part.column("lang").dictionary_encode()
    size = max(len(coded.dictionary), 1)
    once, _ = _counted(of_text * size + coded.indices.to_numpy())
    pairs, n = _counted(langs.indices.to_numpy()[once // size].astype(np.int64) * size + once % size)
    of_lang, of_term = langs.dictionary.take(pa.array(pairs // size)), coded.dictionary.take(pa.array(pairs % size))
    return pa.table({"term": pc.binary_join_element_wise(of_lang, of_term, _MARK), "n": n})


def _occurrences(part: pa.RecordBatch, texts: list[bytes]) -> pa.Table:
    """(source, term, n): how often documents of a source and lang have the term; its lang is in front."""
    of_text, found = terms(texts)
    coded = found.dictionary_encode()
    langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
    size, many = max(len(coded.dictionary), 1), max(len(sources.dictionary), 1)
    group = langs.indices.to_numpy().astype(np.int64) * many + sources.indices.to_numpy()
    pairs, n = _counted(group[of_text] * size + coded.indices.to_numpy())
    group, of_term = pairs // size, coded.dictionary.take(pa.array(pairs % size))
    marked = pc.binary_join_element_wise(langs.dictionary.take(pa.array(group // many)), of_term, _MARK)
    return pa.table({"source": sources.dictionary.take(pa.array(group % many)), "term": marked, "n": n})


def _layers(min_df: int):
    """Rows of terms: each term is in as many of them as in documents at hand, up to ``min_df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _added(_documents(*x) for x in _slices(batches)):
            n = np.minimum(table["n"].to_numpy(), min_df)
            layer = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            marked = table["term"].combine_chunks().take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_pydict({"terms": _lists(layer, marked, LISTED)[1]})

    return run


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of source, times and the terms that are so often in documents of the source at hand."""
    for table in _added(_occurrences(*x) for x in _slices(batches)):
        source, times = table["source"].combine_chunks(), table["n"].to_numpy()
        code = source.dictionary_encode().indices.to_numpy().astype(np.int64)
        own, lists = _lists(code * (times.max(initial=0) + 1) + times, table["term"].combine_chunks())
        yield pa.RecordBatch.from_pydict({"source": source.take(pa.array(own)), "times": pa.array(times[own]), "terms": lists})


def by_source(docs: DataFrame) -> DataFrame:
    """``docs`` in ranges of lang and source, so that a task meets few of them and adds up more.

    Documents of a source are dealt by the hash of ``doc_id``, if there is one, or of the
    text, so that a large source spreads over many tasks.
    """
    dealt = docs.withColumn("dealt", F.xxhash64("doc_id" if "doc_id" in docs.columns else "text"))
    return dealt.repartitionByRange("lang", "source", "dealt").select("text", "lang", "source")


def count_vectors(docs: DataFrame, min_df: int) -> tuple[DataFrame, DataFrame]:
    """(source, times, vector) and the vocabulary as (index, lang, term).

    One fit counts the terms of every language by itself, as a term enters with its
    language in front, and keeps all that are in at least ``min_df`` documents of it.
    CountVectorizer gathers the vocabulary in the driver and sends it to every executor:
    that much of a corpus, its frequent terms, must fit there.

    It takes its time by the term it is given, so terms are counted where the texts lie. The
    fit is given rows in which a term is as often as in documents, up to ``min_df``, which
    decides as they do; the model is given the terms that are equally often in a source's
    documents at hand, so a vector marks them and holds for all ``times``.
    """
    layers = docs.select("text", "lang").mapInArrow(_layers(min_df), "terms array<string>")
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=_MAX_INT).fit(layers)
    path = work_dir(docs.sparkSession, "vocabulary")
    model.save(path)
    keys = docs.sparkSession.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "key"))
    vocabulary = keys.withColumn("term", F.substring_index("key", _MARK, -1)).select(
        "index", F.expr("left(key, length(key) - length(term) - 1)").alias("lang"), "term"
    )
    bags = docs.select("text", "lang", "source").mapInArrow(_bags, "source string, times long, terms array<string>")
    return model.transform(bags).select("source", "times", "vector"), vocabulary


def group_sums(vectors: DataFrame) -> DataFrame:
    """(source, index, count): how often every source has each term of its sparse vectors.

    Only entries that occur are summed, before the shuffle and after it, so a hot source
    costs a row per term and task, and no dense vector is ever made.
    """
    entries = vectors.select("source", "times", F.explode(F.unwrap_udt("vector")["indices"]).alias("index"))
    return entries.groupBy("source", "index").agg(F.sum("times").alias("count"))


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); for shares up to 10^9 + 1 it stays in 64 bits."""
    return (p - q) ** 2 // (p + q)


TILE = "lang string, one string, other string, value long"


def _tile(group: pd.DataFrame) -> pd.DataFrame:
    """Partial sums for the pairs of sources of a tile.

    Where a pair has a term in common, both shares count in place of the two shares of a
    count of 0 (``rest``). Profiles carry a source's terms without regard to the others.
    """
    lang, a, b = group["lang"].iloc[0], group["a"].iloc[0], group["b"].iloc[0]
    names, code = np.unique(group["source"].to_numpy(), return_inverse=True)
    rest, block = np.zeros((2, len(names)), np.int64)
    rest[code], block[code] = group["rest"], group["block"]
    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    place = np.zeros(len(names), np.int64)
    place[left] = np.arange(len(left))
    column = np.zeros(len(names), np.int64)
    column[right] = np.arange(len(right))
    total = np.zeros((len(left), len(right)), np.int64)
    p, profile = group["p"].to_numpy(), group["slice"].iloc[0] < 0
    if profile:
        times = group["times"].to_numpy()
        v = int(group["v"].max())
        total += v * divergence(rest[left][:, None], rest[right][None, :])
        for k in range(len(names)):
            at = np.flatnonzero(code == k)
            for i in range(0, len(at), 4096):
                mine, n = p[at[i : i + 4096]][:, None], times[at[i : i + 4096]][:, None]
                if block[k] == a:
                    q = rest[right][None, :]
                    total[place[k]] += (n * (divergence(mine, q) - divergence(rest[k], q))).sum(axis=0)
                if block[k] == b:
                    q = rest[left][None, :]
                    total[:, column[k]] += (n * (divergence(mine, q) - divergence(rest[k], q))).sum(axis=0)
    else:
        order = np.argsort(group["index"].to_numpy(), kind="stable")
        ends = np.flatnonzero(np.diff(group["index"].to_numpy()[order])) + 1
        for at in np.split(order, ends):
            rows, columns = at[block[code[at]] == a], at[block[code[at]] == b]
            x, y = code[rows][:, None], code[columns][None, :]
            here, there = p[rows][:, None], p[columns][None, :]
            both = divergence(here, there) + divergence(rest[x], rest[y])
            total[place[x], column[y]] += both - divergence(here, rest[y]) - divergence(rest[x], there)
    keep = names[left][:, None] < names[right][None, :] if a == b else np.ones_like(total, bool)
    i, j = np.nonzero(keep & (profile | (total != 0)))
    return pd.DataFrame({"lang": lang, "one": names[left[i]], "other": names[right[j]], "value": total[i, j]})


def pair_values(entries: DataFrame, groups: DataFrame, sources_per_tile: int = 256, entries_per_slice: int = 20_000) -> DataFrame:
    """(lang, source, item, value) for all pairs of sources of a language, in both directions.

    ``entries`` has (lang, source, index, count, p), ``groups`` (lang, source, v, rest). A pair
    is evaluated from its sparse sums: of terms that neither has, or just one, it is
    enough to know how many have which count. So each source sends one profile, its
    counts and how often each occurs, and only terms that two sources share are looked
    at pairwise. Sources are dealt into blocks, terms into slices: a task holds two blocks
    and a slice at most, and emits sums of pairs, never pairs by term.
    """
    most = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks, slices = -(-most // sources_per_tile) or 1, -(-entries.count() // entries_per_slice) or 1
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).alias("block")
    shared = entries.select(
        "lang", "source", block, F.pmod(F.xxhash64("index"), F.lit(slices)).alias("slice"), "index", "p", "rest",
        F.lit(1).cast("long").alias("times"), "v",
    )
    profiles = entries.groupBy("lang", "source", "p", "rest", "v").agg(F.count("*").alias("times"))
    profiles = profiles.unionByName(groups.select("lang", "source", F.col("rest").alias("p"), "rest", "v", F.lit(0).cast("long").alias("times")))
    profiles = profiles.select("lang", "source", block, F.lit(-1).cast("long").alias("slice"), F.lit(-1).alias("index"), "p", "rest", "times", "v")
    met = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.least("block", o).alias("a"), F.greatest("block", o).alias("b")))
    dealt = shared.unionByName(profiles).withColumn("tile", F.explode(met)).select("*", "tile.a", "tile.b").drop("tile")
    sums = dealt.groupBy("lang", "a", "b", "slice").applyInPandas(_tile, TILE).groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    there = sums.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value")
    return there.unionByName(sums.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value"))


def audit_sources(docs: DataFrame, min_df: int = 10, top: int = 10) -> DataFrame:
    """How each source differs: lang, source, part, item, value, rank.

    Part ``pair`` has, for every (lang, source), all other sources of the language by
    divergence, summed over all kept terms; part ``term`` its ``top`` terms with a share
    above the language's. Shares, divergences and sums are integers and exact. Ranks fall
    by value, ties rise by item.

    A NULL text, lang or source counts as empty, so documents of a NULL and an empty lang
    are one language. Sources without kept terms still have their pairs, and where a
    language keeps no term all values are 0. A source that is alone has no pairs. Repeated
    rows count each. An empty table gives an empty result; of other columns only ``doc_id``
    is looked at, to deal documents to tasks.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    plain = docs.select(*texts)
    vectors, vocabulary = count_vectors(by_source(docs.select(*texts, *[c for c in docs.columns if c == "doc_id"])), min_df)
    sums = stage(group_sums(vectors), "source-sums").join(vocabulary, "index")
    per_lang = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    counted = sums.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = plain.select("lang", "source").distinct().join(counted, ["lang", "source"], "left").join(per_lang, "lang", "left")
    lang_n = F.coalesce(F.sum("n").over(Window.partitionBy("lang")), F.lit(0)).alias("lang_n")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), lang_n)
    # where no term is kept no share exists; 1 keeps the tiles defined, and their sums 0
    rest = F.when(F.col("v") > 0, F.expr(_SHARE.format(count="0L", n="n", v="v"))).otherwise(1).cast("long").alias("rest")
    groups = stage(groups.select("*", rest), "source-groups")
    everywhere = F.sum("count").over(Window.partitionBy("index")).alias("lang_count")
    entries = sums.select("*", everywhere).join(groups, ["lang", "source"]).select(
        "lang", "source", "index", "term", "v", "rest",
        F.expr(_SHARE.format(count="count", n="n", v="v")).alias("p"), F.expr(_SHARE.format(count="lang_count", n="lang_n", v="v")).alias("q"),
    )
    entries = stage(entries, "source-entries")

    pairs = pair_values(entries.drop("term", "q"), groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    value = F.expr("((p - q) * (p - q)) div (p + q)").alias("value")
    typical = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value)
    return pairs.select("*", rank.alias("rank")).unionByName(typical.select("*", rank.alias("rank")).where(F.col("rank") <= top))
