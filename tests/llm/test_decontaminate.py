from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pitsync.llm import decontaminate as d
from pitsync.llm.sql import decontamination
from tests.oracle import connect


@pytest.fixture(scope="module")
def edited(spark):
    """Documents with exact, edited, reordered and cut passages of made-up items."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    items = [[rng.choice(words) for _ in range(rng.choice([1, 3, 5, 9, 20, 40, 59]))] for _ in range(40)]
    items.append(["again"] * 12)
    docs = []
    for k in range(200):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 120))]
        part = list(rng.choice(items))
        for _ in range(rng.randrange(0, 4)):
            way, at = rng.randrange(4), rng.randrange(len(part))
            if way == 0:
                part[at] = "changed"
            elif way == 1 and len(part) > 1:
                del part[at]
            elif way == 2:
                part.insert(at, "added")
            else:
                part = part[at:] + part[:at]
        at = rng.randrange(len(body) + 1)
        docs.append((k, " ".join(body[:at] + part + body[at:]).upper() if k % 7 == 0 else "\t".join(body[:at] + part + body[at:])))
    docs += [(1000, None), (1001, ""), (1002, " \n "), (None, " ".join(items[-1])), (1003, "x " * 800 + " ".join(items[5])), (0, docs[0][1])]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"sh": F.lit(1), "n": F.lit(2), "block": F.lit(3)})
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(100, None), (101, ""), (102, " ".join(items[20]))]
    return docs, spark.createDataFrame(bench, "item_id long, text string")


def found(docs, bench, **options):
    rows = d.contaminated(docs, bench, **options).collect()
    return {(r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in rows}


def test_finds_what_all_windows_give(edited):
    docs, bench = edited
    con = connect("/root/testdata/sf0.001")
    con.register("documents_fixture", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("bench_rows", bench.toPandas())
    con.execute("CREATE OR REPLACE VIEW benchmark AS SELECT * FROM bench_rows")
    rows = con.sql(f"WITH {decontamination('documents_fixture')} SELECT doc_id, item_id, similarity FROM matches").fetchall()
    want = {(i, k, round(x, 9)) for i, k, x in rows}
    got = found(docs, bench)
    assert len(got) > 50 and got == want
    bad = {i for i, _, _ in got}
    assert None in bad and {1000, 1001, 1002}.isdisjoint(bad)
    left = d.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()} - bad


def test_beyond_the_broadcast_bound_and_without_rows(edited, make_docs):
    docs, bench = edited
    docs, bench = docs.where("doc_id < 60"), bench.where("item_id < 12")
    assert found(docs, bench, broadcast_rows=0) == found(docs, bench)
    long = "x " * 30_000 + bench.where("item_id = 11").first()["text"]
    assert 7 in {i for i, _, _ in found(make_docs([(7, long), (8, "x " * 30_000)]), bench)}
    assert d.decontaminate(make_docs([]), bench).count() == 0
    assert d.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_fingerprint_is_the_majority_of_bits(spark):
    rng = random.Random(1)
    bags = [[rng.randrange(-(2**63), 2**63) for _ in range(n)] for n in (1, 2, 5, 60, 400)]
    rows = spark.createDataFrame([(b,) for b in bags], "sh array<long>").select(d._fingerprint("sh").alias("f")).collect()
    for bag, row in zip(bags, rows, strict=True):
        want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in bag) > len(bag))
        assert row["f"] & (2**64 - 1) == want


@pytest.mark.parametrize("radius", [0, 3, 24])
def test_blocks_cover_every_fingerprint_within_the_radius(spark, radius):
    rng = random.Random(radius)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), radius):
            b ^= 1 << bit
        rows.append((a - 2**63, b - 2**63))
    got = spark.createDataFrame(rows, "a long, b long").select(
        F.expr(f"exists(zip_with({d._blocks('a', radius)}, {d._blocks('b', radius)}, (x, y) -> x = y), z -> z)").alias("met")
    )
    assert got.where("NOT met").count() == 0


def test_finds_passages_that_repeat_a_shingle_less_often(spark):
    """A bag of which one shingle alone would move all bits: its fingerprint must not."""
    rng = random.Random(4)
    bench, docs = [], []
    for k in range(40):
        fold, others = ((8, 19), (9, 46), (6, 25))[k % 3]
        # "again" fold + 4 times is one shingle fold times
        body = [f"v{rng.randrange(10**9)}" for _ in range(others)]
        bench.append((k, " ".join(body + ["again"] * (fold + 4))))
        docs.append((k, " ".join(["before"] * 9 + body + ["again"] * 5)))
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    con = connect("/root/testdata/sf0.001")
    con.register("documents_fixture", docs.toPandas())
    con.register("bench_rows", bench.toPandas())
    con.execute("CREATE OR REPLACE VIEW benchmark AS SELECT * FROM bench_rows")
    rows = con.sql(f"WITH {decontamination('documents_fixture')} SELECT doc_id, item_id, similarity FROM matches").fetchall()
    want = {(i, k, round(x, 9)) for i, k, x in rows}
    assert len(want) >= 26 and found(docs, bench) == want
