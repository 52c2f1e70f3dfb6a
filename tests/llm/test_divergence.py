from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from pitsync.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_df=10, top=10):
    """All sources against each other over all kept terms, in Python's integers."""
    out = []
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    for lang in {r[1] for r in rows}:
        mine = [(s, Counter(_terms(t))) for t, x, s in rows if x == lang]
        seen = Counter(w for _, c in mine for w in c)
        kept = sorted(w for w, n in seen.items() if n >= min_df)
        groups = {s: Counter() for s, _ in mine}
        for s, c in mine:
            groups[s].update({w: n for w, n in c.items() if w in set(kept)})
        whole = sum(groups.values(), Counter())

        def share(counts):
            total = sum(counts.values())
            return {w: 1 + 10**9 * (counts[w] + 2) // (total + 2 * len(kept)) for w in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            f = {o: sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept) for o in groups if o != s}
            g = {w: (p[s][w] - q[w]) ** 2 // (p[s][w] + q[w]) for w in kept if groups[s][w] and p[s][w] > q[w]}
            for part, values, most in (("pair", f, None), ("term", g, top)):
                ranked = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(ranked)]
    return sorted(out)


def _frame(spark, rows):
    full = [(k, *r, "x", 1, 2) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id int, text string, lang string, source string, term string, index int, value int")


def _check(spark, rows, **options):
    got = divergence.audit_sources(_frame(spark, rows), **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, **options)


def test_odd_rows(spark):
    rng = random.Random(4)
    words = ["Ab", "aB", "É", "é", "ıI", "x9y", "日本", "don't", "_z_", "ß"]
    rows = [(" ".join(rng.choices(words[: 3 + k % 8], k=rng.randrange(30))), [None, "", "en", "fr"][k % 4], [None, "", "a", "b", "é"][k % 5]) for k in range(240)]
    rows += [(None, "en", "only nulls"), ("", "zz", "alone"), ("rare words", "rare", "s1"), ("rare words", "rare", "s2")]
    rows += [("Long " * 200_000, "en", "a"), ("hot text", "en", "hot")] + [("hot text", "en", "hot")] * 120
    _check(spark, rows)


def test_nothing_kept_and_no_rows(spark):
    _check(spark, [("a b", "en", "x"), ("a b", "en", "y"), ("c", "de", "x")])
    _check(spark, [])
    _check(spark, [("one", "en", "x")] * 12, min_df=10)


@pytest.mark.parametrize(("sources", "entries"), [(2, 7), (3, 1000), (100, 3)])
def test_tiles_and_slices_sum_up(spark, sources, entries, monkeypatch):
    rng = random.Random(9)
    rows = [(" ".join(rng.choices("abcdefghij"[: 2 + k % 9], k=20)), "en" if k % 3 else "de", f"s{k % 11}") for k in range(200)]
    plain = divergence.pair_values
    monkeypatch.setattr(divergence, "pair_values", lambda e, g: plain(e, g, sources, entries))
    _check(spark, rows, min_df=2)


def test_shares_are_exact_for_large_counts(spark):
    n, c, v = 9_000_000_000_000_000_000, 8_999_999_999_999_999_990, 3
    got = spark.sql("SELECT " + divergence._SHARE.format(count=f"{c}L", n=f"{n}L", v=f"{v}L")).first()[0]
    assert got == 1 + 10**9 * (c + 2) // (n + 2 * v)


def test_vectorizer_is_given_each_term_once_a_count(monkeypatch):
    rng = random.Random(3)
    rows = [(" ".join(rng.choices(["Ab", "aB", "É", "ß-x", "q\0r", "日本", "s\u00a0t"], k=k % 40)), "de" if k % 3 else "", f"s{k % 5}") for k in range(150)]
    assert [divergence.terms([t.encode()])[1].to_pylist() for t, _, _ in rows] == [_terms(t) for t, _, _ in rows]
    text, lang, source = (list(c) for c in zip(*rows, strict=True))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(text), "lang": pa.array(lang), "source": pa.array(source)})
    for held, added in ((10**6, 10**6), (300, 10**6), (300, 40), (1, 1)):
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "ADDED", added)
        layers, bags = (list(run(iter([batch, batch.slice(0, 0)]))) for run in (divergence._layers(10), divergence._bags))
        given = Counter(t for b in layers for row in b["terms"].to_pylist() for t in set(row))
        whole = Counter(f"{x}\0{w}" for t, x, _ in rows for w in set(_terms(t)))
        assert {t for t, n in given.items() if n >= 10} == {t for t, n in whole.items() if n >= 10}
        got = Counter()
        for b in bags:
            for r in b.to_pylist():
                got.update({(r["source"], t): r["times"] for t in r["terms"]})
        assert got == Counter((s, f"{x}\0{w}") for t, x, s in rows for w in _terms(t))
        if added == 10**6:
            assert sum(len(row) for b in layers for row in b["terms"].to_pylist()) <= 10 * len(whole)
            assert sum(len(row) for b in bags for row in b["terms"].to_pylist()) == len(got)


def test_lists_given_to_the_vectorizer_are_bounded(monkeypatch):
    monkeypatch.setattr(divergence, "LISTED", 3)
    text = pa.array([" ".join("abcdefgh"), "a b c", "h h", ""])
    batch = pa.RecordBatch.from_pydict({"text": text, "lang": pa.array(["en"] * 4), "source": pa.array(["s", "s", "t", "t"])})
    layers = [row for b in divergence._layers(2)(iter([batch])) for row in b["terms"].to_pylist()]
    assert max(map(len, layers)) == 3 and all(len(row) == len(set(row)) for row in layers)
    assert Counter(t for row in layers for t in row) == {f"en\0{t}": 2 if t in "abch" else 1 for t in "abcdefgh"}
    bags = [r for b in divergence._bags(iter([batch])) for r in b.to_pylist()]
    got = sorted((r["source"], t, r["times"]) for r in bags for t in r["terms"])
    assert got == sorted([("s", f"en\0{t}", 2 if t in "abc" else 1) for t in "abcdefgh"] + [("t", "en\0h", 2)])


def test_tasks_meet_few_sources_and_a_hot_one_spreads(spark):
    rows = [(f"text {k % 5}", ["de", "en"][k % 2], "hot" if k % 4 else f"s{k % 3}") for k in range(2000)]
    docs = _frame(spark, rows).repartition(7)
    near = divergence.by_source(docs)
    assert near.columns == ["text", "lang", "source"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = [Counter(map(tuple, p)) for p in near.rdd.glom().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts, Counter()) == Counter(rows)
    whole = docs.select("text", "lang", "source").rdd.glom().map(lambda p: len({(r[1], r[2]) for r in p})).collect()
    assert max(len({r[1:] for r in p}) for p in parts) < max(whole)
    hot = [sum(n for r, n in p.items() if r[1:] == ("en", "hot")) for p in parts]
    assert max(hot) < sum(hot)
    assert divergence.by_source(docs.select("text", "lang", "source")).count() == 2000
