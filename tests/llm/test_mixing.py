from __future__ import annotations

import hashlib
import re

import pytest

from pitsync.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """{source: target} by resharing what is above the caps, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while len(capped) < len(sizes):
        rest, w = budget - sum(2.0 * sizes[s] for s in capped), sum(weight[s] for s in sizes if s not in capped)
        above = {s for s in sizes if s not in capped and weight[s] * (rest / w) > 2.0 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * (rest / w) for s in sizes}
        capped |= above
    return {s: 2.0 * sizes[s] for s in sizes}


def brute(rows):
    docs = [(i, t or "", s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sizes = {}
    for _, _, s, n in docs:
        sizes[s] = sizes.get(s, 0) + n
    want = targets(sizes)
    line = []
    for source in sizes:
        queue = []
        for copy in (1, 2):
            for at, (i, t, s, n) in enumerate(docs):
                if s == source:
                    text = hashlib.sha256(t.encode()).hexdigest()
                    queue.append((copy, hashlib.sha256(f"7:{copy}:{'-' if i is None else i}:{text}".encode()).hexdigest(), at, n))
        done = 0
        for copy, place, at, n in sorted(queue):
            done += n
            line.append((done / want[source] if want[source] else 0.0, (source is None, (source or "").encode()), copy, place, at, n))
    taken, used, budget = [0] * len(docs), 0, sum(sizes.values()) * 3 // 2
    for *_, at, n in sorted(line):
        used += n
        if used <= budget:
            taken[at] += n
    return sorted(((i, n, sizes[s], want[s], taken[k]) for k, (i, _, s, n) in enumerate(docs)), key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, source string, place string, total int, copy int")


def _check(spark, rows):
    got = mixing.mix(_frame(spark, rows))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = got.collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    return got


def test_sources_come_near_their_targets_and_reruns_agree(spark, documents):
    got = mixing.mix(documents).collect()
    assert sorted(got) == sorted(mixing.mix(documents.repartition(7)).collect())
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    taken, target, longest = {}, {}, max(r["size"] for r in got)
    for r in got:
        s = source[r["doc_id"]]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
    assert all(abs(taken[s] - target[s]) <= longest for s in taken)
    assert sum(taken.values()) <= sum(target.values()) < sum(taken.values()) + longest + 1


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 40), [None, "", "b", "é", "z", "hot", "hot", "hot"][i % 8]) for i in range(400)]
    rows += [(None, "null id", "b")] * 2 + [(7, "twice here", "b")] * 2 + [(8, None, "empty"), (9, "", "empty"), (10, "word " * 50_000, "long"), (11, "tiny", "small")]
    _check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, "one two three", "a")], [(1, None, None)], [(1, "a b", None), (2, "c d", "x")]])
def test_small_tables(spark, rows):
    _check(spark, rows)


def test_a_small_heavy_source_stops_at_twice_its_size(spark):
    rows = [(1, "w " * 10, "a")] + [(k, "w " * 50, "b") for k in range(2, 30)] + [(k, "w " * 50, "c") for k in range(30, 60)]
    got = {r["doc_id"]: r for r in _check(spark, rows)}
    assert got[1]["target"] == 20.0 and got[1]["taken"] == 20
