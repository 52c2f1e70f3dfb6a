"""Packing of tokenized documents into sequences by swap-based local search."""

from __future__ import annotations

import base64
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.llm.staging import stage

END = 2
#: The added tokens of byte_bpe_50k.json, which its rank form does not list.
ADDED = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str):
    """A function from a text to its ids as unsigned 32-bit integers in bytes.

    It reads the rank form of the vocabulary, which gives the same ids as the JSON form
    read by ``tokenizers`` (tests compare them) in a fraction of the time. The added tokens
    of the JSON form have their own ids wherever a text holds them. Texts that the fast way
    gives up on, such as those with a million blanks in a row, go through ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)

    slow: list[Tokenizer] = []

    def ids(text: str) -> bytes:
        try:
            return own.encode_to_numpy(text, allowed_special="all").tobytes()
        except (ValueError, RuntimeError):  # its pattern matcher ran out of stack
            if not slow:
                slow.append(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
            return array("I", slow[0].encode(text, add_special_tokens=False).ids).tobytes()

    return ids


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


PIECE = "row_no long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = tokenizer(path), array("I", [END]).tobytes()
        for frame in frames:
            out = []
            for row_no, doc_id, text in zip(frame["row_no"], frame["doc_id"], frame["text"], strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                start, stop, piece = 0, (n - 1) % size + 1, 0
                while start < n:
                    out.append((row_no, doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + size, piece + 1
            made = pd.DataFrame(out, columns=["row_no", "doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.astype({"doc_id": "Int64"})

    return run


def pack(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of indexes of ``lengths``, each at most ``size`` long in all.

    Best fit from the longest down gives a start. Then a local search takes the bins that
    are not full, the emptiest first, and moves one of their documents into another bin,
    or exchanges it for a shorter document of another bin, or two shorter ones, or two of
    its documents for one, wherever the other bin stays within ``size`` and gets fuller.
    As the other bin is the fuller of the two, each step increases the sum of the squared
    fills, which ends the search; bins that run empty are gone.
    """
    bins: list[list[int]] = []
    fill: list[int] = []
    room: dict[int, list[int]] = defaultdict(list)
    free = np.zeros(size + 1, dtype=bool)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = int(np.argmax(free[need:])) + need if need < size else size
        if at <= size and free[at] and at >= need:
            b = room[at].pop()
            free[at] = bool(room[at])
        else:
            b = len(bins)
            bins.append([])
            fill.append(0)
        bins[b].append(i)
        fill[b] += need
        rest = size - fill[b]
        if rest:
            room[rest].append(b)
            free[rest] = True
    size_of = lengths.tolist()
    _improve(bins, fill, size_of, size)
    return [b for b in bins if b]


def _improve(bins: list[list[int]], fill: list[int], size_of: list[int], size: int, tries: int = 24) -> None:
    open_bins = [b for b in range(len(bins)) if 0 < fill[b] < size]
    #: reach[x]: (bin, documents that leave it) for which a document of x fills the bin
    reach: list[list[tuple[int, tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    stamp = [0] * len(bins)

    def offer(b: int) -> None:
        """List what bin b could take in, for what it would give."""
        rest, own = size - fill[b], bins[b]
        if not rest:
            return
        reach[rest].append((b, (), stamp[b]))
        for k, i in enumerate(own):
            reach[min(size, size_of[i] + rest)].append((b, (i,), stamp[b]))
            for j in own[k + 1 : k + 6]:
                x = size_of[i] + size_of[j] + rest
                if x <= size:
                    reach[x].append((b, (i, j), stamp[b]))

    def seek(low: int, gives: tuple[int, ...]) -> tuple[int, tuple[int, ...]] | None:
        """A fuller bin that gains by taking ``gives`` of bin low, as nearly full as can be."""
        x = sum(size_of[i] for i in gives)
        for over in range(min(tries, size - x + 1)):
            listed = reach[x + over]
            checked = 0
            while listed and checked < 8:
                b, back, at = listed[-1]
                if stamp[b] != at:
                    listed.pop()
                    continue
                checked += 1
                gain = x - sum(size_of[i] for i in back)
                # two for two is no step of this search
                if b != low and gain > 0 and fill[b] + gain <= size and fill[b] + gain > fill[low] - gain and len(gives) + len(back) < 4:
                    if fill[b] >= fill[low] or gain > fill[low] - fill[b]:
                        return b, back
                listed.insert(0, listed.pop())
        return None

    for b in open_bins:
        offer(b)
    heap = [(fill[b], b) for b in open_bins]
    heapify(heap)
    while heap:
        f, low = heappop(heap)
        if f != fill[low] or not f or f == size:
            continue
        own = sorted(bins[low], key=lambda i: -size_of[i])
        choices = [(i,) for i in own] + [(own[i], own[j]) for i in range(min(6, len(own))) for j in range(i + 1, min(7, len(own)))]
        for gives in choices:
            found = seek(low, gives)
            if found is None:
                continue
            b, back = found
            gain = sum(size_of[i] for i in gives) - sum(size_of[i] for i in back)
            bins[b] = [i for i in bins[b] if i not in back] + list(gives)
            bins[low] = [i for i in bins[low] if i not in gives] + list(back)
            fill[b] += gain
            fill[low] -= gain
            for changed in (b, low):
                stamp[changed] += 1
                if 0 < fill[changed] < size:
                    offer(changed)
                    heappush(heap, (fill[changed], changed))
            break


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _pack_group(size: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row_no", "piece"], ascending=[False, True, True], ignore_index=True)
        bins = pack(group["length"].to_numpy(), size)
        order = np.array([i for b in bins for i in b], dtype=np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = group.iloc[order].reset_index(drop=True)
        ends = out["length"].groupby(number).cumsum()
        out["offset"] = ends - out["length"]
        out["sequence_id"] = number + (group["bucket"].iloc[0] << 32)
        return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run


def pack_documents(docs: DataFrame, ranks_path: str | None = None, size: int = 1024, per_group: int = 20_000) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``size`` tokens.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is
    its token ids and an end token; a null or empty text is the end token alone. Only
    documents longer than ``size`` are cut, into full pieces after a first one that takes
    the remainder.

    Pieces are dealt at random, by a hash, into groups of about ``per_group``, which are
    packed apart from each other (see ``pack``); a group leaves about one bin part empty
    that a common packing would fill. Rows repeated with one doc_id, and rows with a null
    one, are packed each for itself. Empty tables give an empty result, other columns are
    not looked at.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stage(rows.mapInPandas(_pieces(ranks_path or vocabulary(), size), PIECE), "pieces")
    groups = max(1, -(-pieces.count() // per_group))
    bucket = F.pmod(F.xxhash64("row_no", "piece"), F.lit(groups)).alias("bucket")
    return pieces.select("*", bucket).groupBy("bucket").applyInPandas(_pack_group(size), PLACED)
