"""Language ID, quality, language-model scores and the PII tagger."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitsync.llm import bilstm_crf, langid, lm_score, pii, quality

# --- language ID


def test_languages_of_held_out_documents(documents):
    out = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == documents.count() and len(held) > 40
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_of_odd_texts(spark, documents):
    rows = [(900_001, None, "en"), (900_002, "", "en"), (900_003, "12 ++ 3.4\n", None), (900_004, "the and", None), (None, "der und die", "de"), (900_005, "the " * 200_000, None)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = documents.select("doc_id", "text", "lang").unionByName(extra).withColumn("p", F.lit(1))
    out = {r["doc_id"]: r for r in langid.identify(docs).where("doc_id > 900000 OR doc_id IS NULL").collect()}
    assert [out[k]["lang_pred"] for k in (900_001, 900_002, 900_003, 900_004, None, 900_005)] == ["und", "und", "und", "en", "de", "en"]
    assert out[900_001]["score"] == 0 and out[None]["held_out"] is False
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and {900_001, 900_002, 900_003}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_without_training_rows_and_without_rows(make_docs):
    none = make_docs([(1, "text")]).withColumn("lang", F.lit(None).cast("string"))
    assert [tuple(r)[2:] for r in langid.identify(none).collect()] == [("und", 0.0)]
    assert langid.identify(make_docs([])).count() == 0


def test_language_sample_holds_a_text_once_and_is_bounded(spark):
    hot = spark.range(3000).selectExpr("id AS doc_id", "42L AS hash", "10 AS bytes", "'en' AS lang")
    other = spark.range(3000, 3500).selectExpr("id AS doc_id", "xxhash64(id) AS hash", "10 AS bytes", "'en' AS lang")
    long = spark.range(4000, 4010).selectExpr("id AS doc_id", "xxhash64(id) AS hash", "1000 AS bytes", "'de' AS lang")
    labelled = hot.unionByName(other).unionByName(long)
    rows = langid.choose(labelled, 400, 2500).collect()
    by = {lang: [r for r in rows if r["lang"] == lang] for lang in ("en", "de")}
    assert (len(by["en"]), len(by["de"])) == (250, 3)
    assert len({r["hash"] for r in by["en"]}) == 250
    assert [len([r for r in langid.choose(labelled, n, 10**9).collect() if r["lang"] == "en"]) for n in (100, 600)] == [100, 501]
    # a text beyond the bound is learned from all the same
    assert [r["lang"] for r in langid.choose(long, 400, 5).collect()] == ["de"]


def test_copies_of_a_text_do_not_change_predictions(spark, documents):
    learned = documents.where("text IS NOT NULL AND lang IS NOT NULL").where(~langid.holdout(F.col("doc_id"), 3, 1))
    one = learned.orderBy("doc_id").limit(1).select("doc_id", "text", "lang").collect()[0]
    copies = spark.range(2_000_000, 2_003_000).select(F.col("id").alias("doc_id"), F.lit(one["text"]).alias("text"), F.lit(one["lang"]).alias("lang"))
    docs = documents.select("doc_id", "text", "lang")
    plain = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    more = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs.unionByName(copies)).where("doc_id < 2000000").collect()}
    assert more == plain


def test_predictions_ignore_lang_of_held_out_rows(documents):
    held = langid.holdout(F.col("doc_id"), 3, 1)
    changed = documents.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    a, b = ({r["doc_id"]: tuple(r) for r in langid.identify(d).collect()} for d in (documents, changed))
    assert a == b


def test_backoff_goes_from_words_to_shorter_grams():
    tables = [{"und": 0}, {"u": 0}, {"un": 0}, {}, {}]
    logs = [np.array([[-1.0, -5.0]]), np.array([[-7.0, -2.0]]), np.array([[-6.0, -3.0]]), np.zeros((0, 2)), np.zeros((0, 2))]
    s = langid.Scorer(langid.LanguageModel(["de", "en"], tables, logs))
    assert s.word("und").tolist() == [-1, -5]
    assert s.word("unx").tolist() == [-6, -3]
    assert s.word("xu").tolist() == [-7, -2]
    assert s.word("zz").tolist() == [0, 0]


# --- quality


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    good = np.array(labels) == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.score_documents(docs, labels)
    assert out.count() == docs.count()
    held = out.join(labels, "doc_id").where("held_out").collect()
    assert auc([r["score"] for r in held], [r["quality"] for r in held]) > 0.9
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) for r in held)


def test_quality_with_odd_rows_and_labels(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "fine text " * 9), (4, "$$ %% ## " * 9), (None, "x"), (5, "y" * 300_000)])
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for rows in ([], [(3, 1, 0)], [(3, 0, 0)], [(3, 1, 0), (4, 0, 0), (4, None, 1), (None, 1, 1), (3, 1, 0)]):
        out = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, labels(rows)).collect()}
        assert len(out) == 6 and all(0 <= s <= 1 for s in out.values()) and out[1] == out[2]
    assert quality.score_documents(make_docs([]), labels([])).count() == 0


def test_a_repeated_text_is_chosen_once_and_bounds_hold(spark):
    rows = [(k, f"{k:064x}" if k < 600 else "f" * 64, 100 if k % 50 else 5000, k % 2) for k in range(900)]
    labelled = spark.createDataFrame(rows, "doc_id long, hash string, bytes int, quality int")
    got = quality.choose(labelled, 100, 1_000_000).collect()
    assert [sum(r["quality"] == q for r in got) for q in (0, 1)] == [100, 100]
    assert len({(r["hash"], r["quality"]) for r in got}) == 200 and {r["known"] for r in got} == {301}
    # by brute force: the first texts of a class by hash, as long as their bytes are in the bound
    of = {(h, q): (i, b) for i, h, b, q in reversed(rows)}
    for bound in (3000, 20_000):
        want = set()
        for q in (0, 1):
            until = 0
            for h in sorted({h for _, h, _, x in rows if x == q}, key=lambda h: (np.int64(np.uint64(xxhash.xxh64_intdigest(h, 42)).view(np.int64)), h))[:100]:
                until += of[h, q][1]
                if until <= bound:
                    want.add((of[h, q][0], h, q, 301))
        assert {tuple(r) for r in quality.choose(labelled, 100, bound).collect()} == want and want


def test_quality_scores_by_hand(spark, documents):
    """Scores equal those of dictionaries and a line fit here, from texts joined here."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in quality.score_documents(documents, labels).collect()}
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    known = {(hashlib.sha256(text[r["doc_id"]].encode()).hexdigest(), r["quality"], text[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in text and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    rows = sorted(known, key=lambda r: (r[1], r[0]))
    learn, check = [r for r in rows if int(r[0][-4:], 16) % 3], [r for r in rows if not int(r[0][-4:], 16) % 3]
    packed = [zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(quality._dictionary([r[2] for r in learn if r[1] == q], 112_640)), write_content_size=False, write_checksum=False, write_dict_id=False) for q in (1, 0)]

    def gap(t):
        good, bad = (len(c.compress(t.encode())) for c in packed)
        return (bad - good) / (bad + good) if t else 0.0

    slope, offset = quality._logistic(np.array([gap(r[2]) for r in check]), np.array([float(r[1]) for r in check]))
    assert all(abs(got[k] - 1 / (1 + np.exp(-(slope * gap(t or "") + offset)))) < 1e-9 for k, t in text.items())


def test_quality_ignores_labels_of_held_out_rows(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(langid.holdout(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.score_documents(documents, x).collect()} for x in (labels, flipped))
    assert a == b


# --- language-model scores


@pytest.fixture(scope="module")
def coded(documents):
    return lm_score.encoded(documents)


@pytest.fixture(scope="module")
def lm(coded):
    """Trained on nine of ten texts."""
    return lm_score.fit(coded.where("doc_id % 10 <> 3"), every=2, batch_size=256)


def test_scores_equal_token_by_token_sums(documents, texts, lm):
    """The reference walks the tree for one token at a time."""
    got = {r["doc_id"]: r for r in lm_score.score_corpus(documents, lm).collect()}
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size, w = len(lm.tree.first) - 1, lm.weights.astype(np.float64)
    assert len(got) == len(texts) and size == encode.get_vocab_size()
    for doc_id in sorted(texts)[:12]:
        ids, total = encode.encode(texts[doc_id], add_special_tokens=False).ids, 0.0
        for k, token in enumerate(ids):
            hidden = w[-1, :-1].copy()
            for place, step in enumerate((-2, -1, 1, 2)):
                seen = ids[k + step] if 0 <= k + step < len(ids) else size
                hidden += w[seen, :-1] * w[2 * size + place, :-1]
            hidden = np.tanh(hidden)
            for at in range(lm.tree.first[token], lm.tree.first[token + 1]):
                node = w[size + 1 + lm.tree.nodes[at]]
                total -= np.log1p(np.exp(-lm.tree.signs[at] * (node[:-1] @ hidden + node[-1])))
        assert got[doc_id]["n_tokens"] == len(ids) and got[doc_id]["log_likelihood"] == pytest.approx(total, rel=1e-4)


def test_probabilities_sum_to_one_in_any_context(lm):
    size = len(lm.tree.first) - 1
    rng = np.random.default_rng(5)
    for around in (np.full(4, size), rng.integers(0, size, 4), rng.integers(0, 500, 4)):
        scores = lm_score.token_scores(lm, np.arange(size), np.tile(around, (size, 1)))
        assert np.exp(scores).sum() == pytest.approx(1, abs=1e-3)


def test_the_untrained_model_gives_every_token_its_share(spark):
    counts = np.array([5, 0, 1, 1, 30, 2])
    model = lm_score._start(counts, 4, 1)
    scores = lm_score.token_scores(model, np.arange(6), np.full((6, 4), 6))
    assert np.exp(scores) == pytest.approx((counts + 0.5) / (counts + 0.5).sum(), rel=1e-4)


def test_gradient_of_the_window_network():
    rng = np.random.default_rng(2)
    start = lm_score._start(rng.integers(0, 50, 9), 3, 1)
    model = lm_score.WindowModel(start.tree, start.weights.astype(np.float64))
    model.weights[10:18, :3] = rng.normal(0, 1, (8, 3))
    ids, around = rng.integers(0, 9, 12), rng.integers(0, 10, (12, 4))
    slope = np.zeros(model.weights.shape)
    for rows, values in lm_score.gradient(model, ids, around):
        slope[rows] += values
    for row in range(len(slope)):
        for column in range(4):
            kept, sums = model.weights[row, column], []
            for step in (1e-5, -1e-5):
                model.weights[row, column] = kept + step
                sums.append(lm_score.token_scores(model, ids, around).sum())
            model.weights[row, column] = kept
            assert slope[row, column] == pytest.approx((sums[0] - sums[1]) / 2e-5, abs=1e-4)


@pytest.mark.parametrize("crown, hidden", [(0, 3), (1, 4), (3, 3), (20, 4), (99, 3)])
def test_gradient_is_the_same_in_and_below_the_crown(monkeypatch, crown, hidden):
    monkeypatch.setattr(lm_score, "CROWN", crown)
    rng = np.random.default_rng(4)
    start = lm_score._start(rng.integers(0, 900, 40) ** 2, hidden, 1)
    w = start.weights.astype(np.float64)
    w[41:80, :hidden] = rng.normal(0, 1, (39, hidden))
    ids, around, tree = rng.integers(0, 40, 60), rng.integers(0, 41, (60, 4)), start.tree
    want, seen = np.zeros(w.shape), set()
    for token, places in zip(ids, around, strict=True):
        h = np.append(np.tanh(w[-1, :-1] + (w[places, :-1] * w[80:84, :-1]).sum(axis=0)), 1)
        slope = np.zeros(hidden + 1)
        for at in range(tree.first[token], tree.first[token + 1]):
            row, sign = 41 + tree.nodes[at], tree.signs[at]
            g = sign / (1 + np.exp(sign * (w[row] @ h)))
            want[row] += g * h
            slope += g * w[row]
            seen.add(row)
        slope *= 1 - h * h
        np.add.at(want, places, slope * w[80:84])
        want[80:84] += slope * w[places]
        want[84] += slope
    got = np.zeros(w.shape)
    found = lm_score.gradient(lm_score.WindowModel(tree, w), ids, around)
    for rows, slope in found:
        got[rows] += slope
    rows = np.concatenate([r for r, _ in found]).tolist()
    assert got == pytest.approx(want, abs=1e-9)
    assert sorted(rows) == sorted(seen | set(around.ravel().tolist()) | set(range(80, 85)))


def test_most_steps_of_the_corpus_are_in_the_crown(coded, lm):
    tree, crown = lm.tree, lm.tree.crown
    assert crown.sides.shape == (lm_score.CROWN + 1, lm_score.CROWN)
    bound = len(tree.first) - 2 - lm_score.CROWN
    for token in range(0, len(tree.first) - 1, 97):
        path = slice(tree.first[token] + crown.below[token], tree.first[token + 1])
        side = np.zeros(lm_score.CROWN)
        side[tree.nodes[path] - bound] = tree.signs[path]
        assert crown.sides[crown.door[token]].tolist() == side.tolist()
        assert (tree.nodes[tree.first[token] : path.start] < bound).all()
    ids = np.concatenate([r["ids"] for r in coded.collect()])
    assert crown.below[ids].sum() < 0.6 * np.diff(tree.first)[ids].sum()


def test_a_score_is_the_same_whatever_is_scored_with_it(lm):
    rng = np.random.default_rng(6)
    ids, around = rng.integers(0, 300, 500), rng.integers(0, 300, (500, 4))
    whole = lm_score.token_scores(lm, ids, around)
    for some in (slice(7, 8), slice(100, 119), slice(0, 400, 3)):
        assert lm_score.token_scores(lm, ids[some], around[some]).tolist() == whole[some].tolist()


def test_context_is_worth_half_a_nat_on_held_out_texts(coded, lm):
    held = [r["ids"] for r in coded.where("doc_id % 10 = 3").collect()]
    ids, lengths = np.concatenate(held).astype(np.int32), np.array([len(x) for x in held])
    size = len(lm.tree.first) - 1
    counts = np.zeros(size)
    for r in coded.where("doc_id % 10 <> 3").collect():
        np.add.at(counts, r["ids"], 1)
    plain = np.log((counts + 0.5) / (counts + 0.5).sum())[ids].mean()
    assert lm_score.text_scores(lm, ids, lengths).sum() / len(ids) > plain + 0.5


def test_training_takes_every_window_once(monkeypatch, coded):
    train, rounds, seen = lm_score._train, [], []

    def noted(sent, part, parts, rate, batch_size):
        rounds.append((sent, part, parts))
        return train(sent, part, parts, rate, batch_size)

    monkeypatch.setattr(lm_score, "_train", noted)
    lm_score.fit(coded.where("doc_id < 3"))
    monkeypatch.setattr(lm_score, "climb", lambda model, touched, squares, ids, around, rate: seen.extend(ids.tolist()))
    batch = pa.RecordBatch.from_pydict({"ids": pa.array([list(range(1, 40)), [], [40], list(range(41, 101))], pa.list_(pa.int32()))})
    for sent, part, parts in rounds:
        list(train(sent, part, parts, 0.1, 8)(iter([batch])))
    assert sorted(seen) == list(range(1, 101))


def test_batches_are_cut_between_texts(monkeypatch):
    monkeypatch.setattr(lm_score, "TOKENS", 4)
    texts = [[1, 2], [], [3, 4], [5] * 9, [], [6], [7, 8, 9], []]
    batch = pa.RecordBatch.from_pydict({"ids": pa.array(texts, pa.list_(pa.int32()))})
    parts = [p.column("ids").to_pylist() for p in lm_score._pieces(iter([batch, batch.slice(0, 0)]))]
    assert sum(parts, []) == texts and [sum(map(len, p)) for p in parts] == [4, 9, 4]


def test_packed_ids_are_the_same_ids(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "one two"), (4, "three <|endoftext|> é"), (None, "x" * 5000)])
    arrays = {r["doc_id"]: r["ids"] for r in lm_score.encoded(docs).collect()}
    packed = lm_score.encoded(docs, packed=True)
    assert packed.schema["ids"].dataType.simpleString() == "binary"
    batch = packed.toArrow().combine_chunks().to_batches()[0]
    ids, lengths = lm_score._lists(batch.slice(1))
    keys = batch.column("doc_id").to_pylist()[1:]
    assert ids.tolist() == sum((arrays[k] for k in keys), []) and lengths.tolist() == [len(arrays[k]) for k in keys]


def test_windows_end_where_their_text_ends(coded):
    edge, lengths = 99, np.array([3, 0, 1])
    assert lm_score.windows(*lm_score.padded(np.array([1, 2, 3, 4]), lengths, edge)).tolist() == [[99, 99, 2, 3], [99, 1, 3, 99], [1, 2, 99, 99], [99, 99, 99, 99]]
    with pytest.raises(ValueError):
        lm_score.fit(coded, every=2, rounds=3)


def test_counts_cover_all_documents_and_odd_texts(make_docs, coded, texts):
    docs = make_docs([(1, None), (2, ""), (3, "one"), (4, "a b " * 50_000), (None, "one"), (3, "one"), (5, " " * 2_000_000)])
    out = lm_score.score_corpus(docs).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == 7 and by[1]["n_tokens"] == 0 and by[1]["log_likelihood"] == 0 and by[2]["mean_log_likelihood"] is None
    assert by[3]["log_likelihood"] == by[None]["log_likelihood"] < 0 and by[4]["n_tokens"] >= 100_000
    assert lm_score.score_corpus(make_docs([])).count() == 0
    size = lm_score.vocabulary_size()
    cells = coded.select("ids").mapInArrow(lm_score._token_counts(size), "token int, n long").agg(F.sum("n")).first()[0]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert cells == sum(len(encode.encode(t, add_special_tokens=False).ids) for t in texts.values())


# --- personal data


def test_gradient_of_the_tagger():
    rng = np.random.default_rng(0)
    p = bilstm_crf.new_params(7, 5, 3, 1)
    x, y = rng.integers(0, 7, (4, 9)), rng.integers(0, 5, (4, 9))
    _, gradient = bilstm_crf.loss_and_gradient(p, x, y)
    for name in p:
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in p[name].shape)
            sides = []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                sides.append(bilstm_crf.loss_and_gradient(q, x, y)[0])
            assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(gradient[name][at], abs=1e-6)


def test_viterbi_and_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    p = bilstm_crf.new_params(5, 3, 2, 2)
    p["trans"], p["start"] = rng.normal(size=(3, 3)), rng.normal(size=3)
    e, _ = bilstm_crf.emissions(p, rng.integers(0, 5, (2, 5)))
    prob, _, log_z = bilstm_crf.marginals(p, e)
    for w in range(2):
        paths = list(itertools.product(range(3), repeat=5))
        s = np.array([p["start"][t[0]] + sum(e[k, w, t[k]] for k in range(5)) + sum(p["trans"][a, b] for a, b in zip(t, t[1:])) for t in paths])
        assert log_z[w] == pytest.approx(np.log(np.exp(s).sum()))
        assert bilstm_crf.viterbi(p, e)[:, w].tolist() == list(paths[int(s.argmax())])
        share = np.exp(s - log_z[w])
        assert prob[2, w, 1] == pytest.approx(share[[t[2] == 1 for t in paths]].sum())


PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
ODD = "+1.2.3.4-5 6@7.8 a@b.c@d.e.f +(1) 4111 1111-1111 1111 +49 (030) 1234-5678. 300.1.1.1 0001.2.3.4.5@x-.y é@é.é +1 234 567 890 123 456"


def test_base_spans_equal_the_plain_patterns(texts):
    for text in [*texts.values(), ODD, ODD[::-1], ODD.replace(" ", ""), "9" * 5000, "1." * 5000 + "1"]:
        want = [(m.start(), m.end(), k) for k, r in enumerate(PLAIN) for m in re.finditer(r, text) if pii.valid(k, m.group())]
        assert pii.base_spans(text) == sorted(want, key=lambda s: (s[0], s[2]))


def test_windows_cover_all_that_can_hold_a_span(texts):
    for text in [*texts.values(), "7" * 1000, "a" * 300 + "@" + "b" * 300]:
        covered = {k for a, b in pii.windows(text) for k in range(a, b)}
        assert all(b - a <= pii.LENGTH for a, b in pii.windows(text))
        assert {k for m in re.finditer("[0-9@]", text) for k in range(max(0, m.start() - pii.REACH), min(len(text), m.end() + pii.REACH))} <= covered


def test_tagger_learns_the_spans_and_adds_what_the_patterns_miss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = [r["text"] for r in docs.where("text RLIKE '[0-9@]' AND doc_id % 2 = 0").limit(300).collect()]
    p = pii.fit(docs.where("doc_id % 2 = 1"), max_docs=500)
    x, y = pii.training_set(held)
    tags, _ = pii.decode(p, x)
    assert (tags == y)[y > 0].mean() > 0.9 and (tags == y)[y == 0].mean() > 0.98
    sent = "reach 4111111111111111 5500005555555559 now"
    assert pii.base_spans(sent) == []
    own = pii.windows(sent)
    found = pii.reconcile(own, *pii.decode(p, pii._input(pii.classes(sent), own)))
    assert all(pii.valid(k, sent[a:b]) for a, b, k in pii.added_spans(sent, [], found, 0.0))


def test_pii_of_odd_rows(make_docs, documents):
    docs = make_docs([(1, None), (2, ""), (3, "é🎉 a@b.cd"), (3, "é🎉 a@b.cd"), (None, "1.2.3.4"), (4, "x1 " * 100_000 + "q@r.st")])
    out = {r["doc_id"]: r for r in pii.find_pii(docs, steps=5).collect()}
    assert out[1]["spans"] == out[2]["spans"] == "" and out[1]["base_sha256"] == __import__("hashlib").sha256(b"").hexdigest()
    assert out[3]["n_email"] == 1 and "email:3:9" in out[3]["spans"] and out[None]["n_ip"] == 1 and "email:300000:300006" in out[4]["spans"]
    assert pii.find_pii(make_docs([])).count() == 0
