from __future__ import annotations

import hashlib
import zlib

from pitsync.llm import merkle

NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _leaf(row, lower=False):
    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return _h(*[_field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    """A plain tree over all rows, and every leaf's path recomputed from it."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees[lang] = _levels([_leaf(r) for r in groups[lang]])
    top = _levels([trees[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for pos, row in enumerate(groups[lang]):
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            folded, proof = _leaf(row, hit), []
            for levels, place in ((trees[lang], pos), (top, at)):
                for level in levels[:-1]:
                    first = place // 8 * 8
                    run = level[first : first + 8]
                    proof += [x for k, x in enumerate(run) if first + k != place]
                    folded = _h(*[folded if first + k == place else x for k, x in enumerate(run)])
                    place //= 8
            root = top[-1][0]
            out.append((row["doc_id"], _leaf(row), trees[lang][-1][0], root, _h(*proof), folded, folded == root))
    return sorted(out, key=str)


def _check(spark, rows, **more):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tree int, pos int, leaf string, now string"
    df = spark.createDataFrame([(*[r[n] for n in NAMES], 1, 2, "x", "y") for r in rows], schema)
    got = merkle.audit_documents(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def _row(doc_id, text="Some Text", lang="en", source="s", n_chars=9):
    return dict(zip(NAMES, (doc_id, text, lang, source, n_chars), strict=True))


def test_given_documents_equal_a_plain_tree(spark, documents):
    rows = [r.asDict() for r in documents.collect()]
    got = merkle.audit_documents(documents).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert 0 < sum(r["verified"] for r in got) < len(got)


def test_odd_rows(spark):
    rows = [_row(i, text="ABC É " * (i % 5), lang=[None, "", "en", "é", "zz"][i % 5]) for i in range(150)]
    rows += [_row(None), _row(None), _row(3), _row(3), _row(7, None, "en", None, None), _row(8, ""), _row(9, "Ä" * 300_000, "long")]
    _check(spark, rows)


def test_one_language_one_leaf_and_none(spark):
    _check(spark, [_row(5)])
    _check(spark, [_row(i) for i in range(9)])
    _check(spark, [_row(i, lang=f"l{i:03}") for i in range(70)])
    _check(spark, [])


def test_a_hot_language_reads_many_copies_of_the_nodes_near_the_root(spark):
    leaves = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'x', 'hot') AS lang", "unhex(sha2(CAST(id AS STRING), 256)) AS leaf")
    leaves = leaves.withColumn("now", leaves["leaf"])
    manifest = merkle.build(leaves, "lang", ["doc_id"], keep=["doc_id", "now"])
    readers = manifest.runs.where("up_tree IS NOT NULL").count()
    parts = manifest.nodes.groupBy("tree", "level", "pos").count().orderBy("count", ascending=False).first()["count"]
    assert parts > 20 and manifest.nodes.count() < readers * 1.6
    checked = merkle.verify(manifest, "now")
    assert checked.where("folded_root <> root").count() == 0 and checked.count() == 20_000
