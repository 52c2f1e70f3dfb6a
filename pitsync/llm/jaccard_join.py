"""Components of documents under the Jaccard similarity of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.llm.components import components
from pitsync.llm.signature_tree import link
from pitsync.llm.staging import stage, unused

#: Bands of minima that bring similar documents together. A pair at a similarity of 0.75 or
#: more shares none of 56 bands of 4 with a chance below (1 - 0.75**4) ** 56 = 6e-10.
BANDS, ROWS = 56, 4
_SEEDS = np.random.default_rng(20240501)
_SLOPES = _SEEDS.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _SEEDS.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_PLACES = _SEEDS.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered for as long as there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text.

    Words are what stands between ASCII white space, with A-Z lower-cased. Fewer words
    than ``width`` make one shingle; null or no words make none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    run = min(width, len(h))
    total = np.full(len(h) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        total += h[k : len(h) - run + 1 + k] * _PLACES[k]
    return np.unique(_mixed(total))


def band_keys(tokens: np.ndarray) -> np.ndarray:
    """One key per band, from the minima of its ``ROWS`` random orders of the tokens."""
    x = (tokens ^ (tokens >> np.uint64(32))).astype(np.uint32)
    low = np.full(BANDS * ROWS, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 4096):
        low = np.minimum(low, (x[i : i + 4096][None, :] * _SLOPES[:, None] + _SHIFTS[:, None]).min(axis=1))
    parts = low.astype(np.uint64).reshape(BANDS, ROWS)
    return _mixed((parts * _PLACES[None, :ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACES[8]).view(np.int64)


def _profiles(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            sets = [shingle_set(t, hashes, width) for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "row_no": frame["row_no"],
                    "doc_id": frame["doc_id"],
                    "n_chars": [len(t or "") for t in frame["text"]],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [
                        xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"empty %d" % r
                        for s, r in zip(sets, frame["row_no"], strict=True)
                    ],
                    "bands": [band_keys(s) if len(s) else [] for s in sets],
                }
            )

    return run


PROFILE = "row_no long, doc_id long, n_chars long, n_shingles long, digest binary, bands array<long>"


def _tasks(width: int, percent: int):
    """Links within the (group, block) tasks of a partition sorted by them."""

    def solve(task: pd.DataFrame, hashes: WordHashes) -> pd.DataFrame:
        sets = [shingle_set(t, hashes, width) for t in task["text"]]
        # entries with one node, and those of one known component, are connected beforehand
        known = pd.factorize(task["known"])[0]
        first = pd.Series(range(len(known))).groupby(known).transform("min").to_numpy()
        side = task["side"].to_numpy() if task["side"].nunique() > 1 else None
        root = link(sets, first, side, percent)
        node = task["node"].to_numpy()
        return pd.DataFrame({"a": node, "b": node[root]}).query("a != b").drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, held, key = WordHashes(), [], None
        for frame in frames:
            for at, part in frame.groupby(["grp", "block"], sort=False):
                if at != key and held:
                    yield solve(pd.concat(held, ignore_index=True), hashes)
                    held = []
                key = at
                held.append(part)
        if held:
            yield solve(pd.concat(held, ignore_index=True), hashes)

    return run


def _linked(tasks: DataFrame, width: int, percent: int) -> DataFrame:
    """Run tasks of (grp, block, node, known, side, text); the links found as (a, b)."""
    dealt = tasks.repartition("grp", "block").sortWithinPartitions("grp", "block", "node")
    return dealt.mapInPandas(_tasks(width, percent), "a long, b long")


def jaccard_components(
    docs: DataFrame, width: int = 5, percent: int = 75, block_docs: int = 4096, block_chars: int = 8_000_000
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents are linked when the Jaccard similarity of their sets of ``width``-word
    shingles is ``percent`` / 100 or more; component_id is the smallest doc_id that links
    lead to.

    1. A pass over the texts gives the size and digest of each set, and its band keys.
       Documents with equal sets become one class, however many they are.
    2. Classes that share a band key are brought into one candidate group.
    3. A group is cut into blocks of about ``block_docs`` documents or ``block_chars``
       characters. Signature trees find all links of a block (see ``signature_tree``).
       Every block of a group also holds the group's pivots, some common members, so
       near copies are connected across blocks. Then only documents outside the group's
       largest component have to meet the other blocks; they do so in pairs of blocks.
    4. Components of the links found, given to every document through its class.

    A set is empty for a null text or one without words: its document is linked with
    nothing. Documents of fewer than ``width`` words have one shingle. Rows with one
    doc_id are one node, whose links are those of all its rows. A row without doc_id has
    the component of its class and brings no links of its own. An empty table gives an
    empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = stage(rows.mapInPandas(_profiles(width), PROFILE), "profiles")
    whole = profiles.where("n_shingles > 0")

    classes = whole.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "bands", "n_chars")).alias("m"))
    # the least struct may be that of a null id; it has the same bands
    classes = stage(classes.where("rep IS NOT NULL").select("digest", "rep", "m.bands", "m.n_chars"), "classes")
    same_id = whole.where("doc_id IS NOT NULL").join(classes.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # ids that stand in several rows tie the classes of those rows together
    repeated = whole.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("doc_id")
    ties = same_id.join(repeated, same_id["a"] == repeated["doc_id"], "left_semi").where("a != b")

    keyed = classes.select("rep", F.explode("bands").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head != last").select("key", "head")
    pairs = keyed.join(heads, "key").where("rep != head").select(F.col("rep").alias("a"), F.col("head").alias("b"))
    groups = stage(components(pairs, "candidates").withColumnsRenamed({"node": "node", "component": "grp"}), "groups")

    size = classes.groupBy("rep").agg(F.max("n_chars").alias("n_chars"))
    members = groups.join(size, groups["node"] == size["rep"]).select("node", "grp", "n_chars")
    cuts = members.groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")).select(
        F.col("grp").alias("g"),
        F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("chars") / block_chars)).cast("long").alias("blocks"),
    )
    members = members.join(cuts, members["grp"] == cuts["g"]).select(
        "node", "grp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members = members.join(texts, members["node"] == texts["doc_id"]).drop("doc_id")
    members = stage(members.where("text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'"), "members")

    # pivots: of a group with several blocks, a few members with the least hash
    pivots = members.where("blocks > 1 AND pmod(xxhash64(node, 7), greatest(1, blocks * 400)) = 0")
    meets = members.withColumn("block", F.col("own")).unionByName(
        pivots.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("block != own")
    )
    tasks = meets.select("grp", "block", "node", F.col("node").alias("known"), F.lit(0).alias("side"), "text")
    links = stage(_linked(tasks, width, percent).unionByName(ties), "links")

    if members.where("blocks > 1").limit(1).count():
        links = links.unionByName(_across(members.where("blocks > 1"), links, width, percent))
    joined = components(links, "components").withColumnsRenamed({"node": "c_node", "component": "c_id"})

    reps = classes.select(F.col("digest").alias("c_digest"), F.col("rep"))
    out = profiles.join(reps, profiles["digest"] == F.col("c_digest"), "left")
    out = out.join(joined, F.col("rep") == F.col("c_node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("c_id", "rep", "doc_id").alias("component_id"))


def _across(members: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between the blocks of groups that have several.

    The largest component of a group after the first pass stays where it is. All other
    members meet the members of every other block, and each other once per pair of blocks.
    """
    known = stage(components(links, "known"), "known").withColumnsRenamed({"node": "k_node", "component": "k_id"})
    members = members.join(known, members["node"] == known["k_node"], "left").withColumn("known", F.coalesce("k_id", "node")).drop("k_node", "k_id")
    members = stage(members, "members")
    sizes = members.groupBy("grp", "known").agg(F.count("*").alias("n"))
    main = sizes.groupBy("grp").agg(F.max(F.struct("n", "known")).alias("top")).select(F.col("grp").alias("g"), F.col("top.known").alias("main"))
    apart = members.join(main, members["grp"] == main["g"]).where("known != main").drop("g", "main")
    # task (i, j): members of block j on side 0, those apart of block i on side 1
    guests = apart.withColumn("host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("host != own")
    from_blocks = apart.select("grp", F.col("own").alias("guest"), "blocks").distinct()
    hosts = members.join(from_blocks.select(F.col("grp").alias("g"), "guest"), members["grp"] == F.col("g")).where("guest != own").drop("g")
    tasks = guests.select("grp", (F.col("own") * F.col("blocks") + F.col("host")).alias("block"), "node", "known", F.lit(1).alias("side"), "text").unionByName(
        hosts.select("grp", (F.col("guest") * F.col("blocks") + F.col("own")).alias("block"), "node", "known", F.lit(0).alias("side"), "text")
    )
    return _linked(tasks, width, percent)


def drop_near_copies(docs: DataFrame, **options: object) -> DataFrame:
    """The documents whose doc_id is the smallest of their component, with all columns.

    Documents without doc_id stay: nothing names them.
    """
    found = jaccard_components(docs, **options)
    gone_id = unused("gone_id", docs)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(gone_id), "left_anti")
