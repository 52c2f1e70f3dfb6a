from __future__ import annotations

import hashlib

from pitsync.llm.exact_dedup import drop_copies, exact_dedup


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_nulls_ties_and_long_texts(make_docs):
    long = "x" * 500_000
    rows = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, long), (7, long), (None, "a"), (None, "only"), (8, "a ")]
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(make_docs(rows)).collect()}
    assert got == {
        (1, sha("a")): (2, 3, False),
        (2, sha("a")): (2, 3, True),
        (None, sha("a")): (2, 3, False),
        (3, sha("A")): (3, 1, True),
        (4, sha("")): (5, 2, False),
        (5, sha("")): (5, 2, True),
        (6, sha(long)): (7, 2, False),
        (7, sha(long)): (7, 2, True),
        (None, sha("only")): (None, 1, True),
        (8, sha("a ")): (8, 1, True),
    }


def test_one_of_repeated_rows_is_kept(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (1, "b"), (0, "a"), (0, "a")])
    got = exact_dedup(docs)
    assert got.where("kept").count() == 2 and got.where("text_sha256 = sha2('a', 256)").first()["group_size"] == 4
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a"), (1, "b")]


def test_smallest_and_any_number_of_rounds(make_docs):
    docs = make_docs([(i, f"t{i % 17}") for i in range(400)]).repartition(13)
    for rounds, fan_in in ((1, 2), (3, 4), (2, 8)):
        got = exact_dedup(docs, "smallest", rounds, fan_in).where("kept").collect()
        assert sorted(r["doc_id"] for r in got) == list(range(17))
    assert exact_dedup(make_docs([])).count() == 0
    assert drop_copies(make_docs([])).count() == 0
