"""The pipeline, stage by stage, against plain versions of what its stages decide."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from pitsync.llm import langid
from pitsync.llm.sql import decontamination
from tests.llm.test_jaccard_join import brute_components
from tests.llm.test_packing import check


def test_stages_do_what_plain_versions_do(spark, con, sf, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing",
    ]
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    scorer = langid.Scorer(langid.fit(documents.where(~langid.holdout(documents["doc_id"], 3, 1))))
    docs, want = documents, rows
    for name, function in corpus_pipeline.STAGES:
        result = function(spark, docs, sf)
        if name == "best_fit_packing":
            check(list(want.items()), result.collect())
            break
        path = corpus_pipeline.work_dir(spark, "test")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "language_id":
            good = {d: scorer.text(t) for d, t in want.items()}
            want = {d: t for d, t in want.items() if good[d][0] != "und" and good[d][1] >= 0.5}
        elif name == "exact_dedup":
            last = {hashlib.sha256(t.encode()).digest(): d for d, t in sorted(want.items())}
            want = {d: want[d] for d in last.values()}
        elif name == "ngram_jaccard_join":
            want = {d: want[d] for d, _, c in brute_components(sorted(want.items())) if c == d}
        else:
            con.register("left_over", docs.toPandas())
            before = con.from_df(spark.createDataFrame(list(want.items()), "doc_id long, text string").toPandas())
            con.register("before_it", before.to_df())
            bad = {r[0] for r in con.sql(f"WITH {decontamination('before_it')} SELECT DISTINCT doc_id FROM matches").fetchall()}
            want = {d: t for d, t in want.items() if d not in bad}
        assert docs.columns == documents.columns
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(want.items())
    assert 0 < len(want) < len(rows)


def test_run_packs_what_is_left(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
