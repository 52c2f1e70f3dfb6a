from __future__ import annotations

import random

import numpy as np
import pytest

from pitsync.llm.components import components
from pitsync.llm.jaccard_join import WordHashes, drop_near_copies, jaccard_components, shingle_set
from pitsync.llm.signature_tree import link


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """(doc_id, n_shingles, component_id) per row, by comparing all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
            if linked or rows[i][0] == rows[j][0] and rows[i][0] is not None and sets[i] and sets[j]:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def edited(rng, base, most):
    words = list(base)
    for _ in range(rng.randrange(most + 1)):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def groups():
    """Groups of near copies of many sizes, a large one, and a passage that many share."""
    rng = random.Random(4)
    texts, passage = [], [f"p{i}" for i in range(30)]
    for g in range(40):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 4, 6, 30, 150]))]
        texts += [" ".join(edited(rng, base, 4)) for _ in range(rng.choice([1, 2, 5]))]
    hot = [f"h{i}" for i in range(120)]
    texts += [" ".join(edited(rng, hot, 6)) for _ in range(150)]
    texts += [" ".join(passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(12, 60))]) for _ in range(80)]
    texts += [texts[0]] * 5 + [texts[0].upper().replace(" ", "\n ")]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [4096, 40])
def test_components_equal_those_of_all_pairs(make_docs, groups, block):
    rows = groups + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one two"), (5004, "ONE two "), (None, "one two"), (None, "alone"), (5003, groups[7][1])]
    got = jaccard_components(make_docs(rows), block_docs=block).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_components(rows)


def test_documents_table_equals_all_pairs(documents, texts):
    rows = sorted(texts.items())
    got = jaccard_components(documents).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_components(rows)


def test_one_of_each_component_stays(make_docs, groups):
    docs = make_docs(groups + [(None, groups[3][1])])
    first = {c for _, _, c in brute_components(groups)}
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == first | {None}
    assert jaccard_components(make_docs([])).count() == 0 and drop_near_copies(make_docs([])).count() == 0


def test_tree_between_two_sides_and_a_very_long_text():
    rng, hashes = random.Random(9), WordHashes()
    base = [f"w{rng.randrange(90_000)}" for _ in range(20_000)]
    sets = [shingle_set(" ".join(edited(rng, base, 40)), hashes) for _ in range(4)]
    sets += [shingle_set(" ".join(f"z{rng.randrange(99)}" for _ in range(60)), hashes) for _ in range(50)]
    assert len(np.unique(link(sets, np.arange(54)))) == 51
    side = np.array([0, 1] * 27)
    assert link(sets, np.arange(54), side)[:4].tolist() == [0, 0, 0, 0]


def test_components_of_chains_hubs_and_nulls(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(260, 300), (1, 1), (None, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(200, 260)} | {260: 260, 300: 260}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0
