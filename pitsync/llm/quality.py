"""Quality classification by compression with dictionaries of good and bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitsync.llm.langid import holdout
from pitsync.llm.staging import stage

LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, and the line from a size difference to the log odds of good."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def _dictionary(texts: list[str], size: int) -> bytes:
    """A zstandard dictionary; of samples too few to train one, their text itself."""
    samples = [t.encode("utf-8", "replace") for t in texts if t]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:]


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.compressors = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
        if not raw:
            return zstandard.ZstdCompressor(level=LEVEL)
        data = zstandard.ZstdCompressionDict(raw)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    def difference(self, text: str | None) -> float:
        """(bad - good) / (bad + good): above 0 if the good dictionary fits better."""
        data = (text or "").encode("utf-8", "replace")
        if not data:
            return 0.0
        good, bad = (len(c.compress(data)) for c in self.compressors)
        return (bad - good) / (bad + good)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-6) -> tuple[float, float]:
    """Slope and offset of a logistic line by Newton steps; slope at least 0."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    # one good and one bad pseudo-row in the middle keep separable data finite
    design = np.concatenate([design, [[x.mean(), 1.0], [x.mean(), 1.0]]])
    y = np.concatenate([y, [0.0, 1.0]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * w)
        w += np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(w[0])), float(w[1])


def choose(labelled: DataFrame, docs_per_class: int, bytes_per_class: int) -> DataFrame:
    """(pick, hash, quality, known) of the texts to learn from: one row per chosen text and label.

    ``labelled`` has (doc_id, hash, bytes, quality). Texts count once, however often they
    are repeated: a class gets ``docs_per_class`` distinct texts at most, the first by
    hash, and of those as many as come within ``bytes_per_class``. ``pick`` is a document
    that has the text, ``known`` the number of distinct texts of the class.
    """
    texts = labelled.groupBy("quality", "hash").agg(F.min("doc_id").alias("pick"), F.max("bytes").alias("bytes"))
    first = Window.partitionBy("quality").orderBy(F.xxhash64("hash"), "hash")
    ranked = texts.select("*", F.row_number().over(first).alias("at")).where(F.col("at") <= docs_per_class)
    filled = ranked.select("*", F.sum("bytes").over(first.rowsBetween(Window.unboundedPreceding, 0)).alias("until"))
    known = texts.groupBy("quality").agg(F.count("*").alias("known"))
    return filled.where(F.col("until") <= bytes_per_class).join(known, "quality").select("pick", "hash", "quality", "known")


def fit(
    docs: DataFrame, labels: DataFrame, docs_per_class: int = 3000, bytes_per_class: int = 48_000_000, dictionary_size: int = 112_640
) -> QualityModel:
    """Learn from ``docs`` (doc_id, text) by ``labels`` (doc_id, quality).

    Null texts and ids and other labels than 0 and 1 are left out. The classifier is fit on
    whole distinct texts, at most ``docs_per_class`` and ``bytes_per_class`` of each label
    (see ``choose``). Labels meet hashes of texts; only the chosen texts are fetched, by a
    join with a table of at most two times ``docs_per_class`` rows. Two of three go into
    the dictionary of their class, the others calibrate the score: their size differences
    are fit to their labels by logistic regression.
    """
    texts = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", F.sha2("text", 256).alias("hash"))
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    keyed = texts.select("doc_id", "hash", F.octet_length("text").alias("bytes"))
    labelled = keyed.join(known, F.col("doc_id") == F.col("label_id")).select("doc_id", "hash", "bytes", "quality")
    chosen = stage(choose(labelled, docs_per_class, bytes_per_class), "quality-sample").withColumnRenamed("hash", "chosen_hash")
    found = texts.join(F.broadcast(chosen), (F.col("doc_id") == F.col("pick")) & (F.col("hash") == F.col("chosen_hash")))
    sample = found.dropDuplicates(["hash", "quality"]).select("text", "quality", "known", "hash").toPandas()
    sample = sample.sort_values(["quality", "hash"], ignore_index=True)
    if sample["quality"].nunique() < 2:
        only = sample["quality"].iloc[0] if len(sample) else None
        return QualityModel(b"", b"", 0.0, {None: 0.0, 0: -2.0, 1: 2.0}[only])
    part = sample["hash"].map(lambda x: int(x[-4:], 16) % 3)
    learn, check = sample[part > 0], sample[part == 0]
    good, bad = (_dictionary(learn.loc[learn["quality"] == k, "text"].tolist(), dictionary_size) for k in (1, 0))
    if check["quality"].nunique() < 2:
        check = sample
    sizes = Sizes(good, bad)
    x = np.array([sizes.difference(t) for t in check["text"]])
    slope, offset = _logistic(x, check["quality"].to_numpy(float))
    stands_for = [sample.loc[sample["quality"] == k, "known"].iloc[0] / (sample["quality"] == k).sum() for k in (1, 0)]
    return QualityModel(good, bad, slope, offset + float(np.log(stands_for[0] / stands_for[1])))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options: object) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``score`` is the calibrated probability that the whole text is of label 1 and
    ``predicted`` 1 if it reaches ``threshold``. Labels are learned from documents that are
    not held out (crc32 of doc_id mod 4 is 2). A null or empty text compresses alike
    under both dictionaries and gets the score of no difference. With labels of one kind
    only, all scores lean to it; without labels they are 0.5. Repeated rows get equal
    scores, and a text is learned from once per label, whatever its copies.
    """
    held = holdout(F.col("doc_id"), 4, 2)
    model = fit(docs.where(~held), labels, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        sizes = Sizes(m.good, m.bad)
        for texts in batches:
            z = m.slope * np.array([sizes.difference(t) for t in texts], dtype=float) + m.offset
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    out = docs.select("doc_id", held.alias("held_out"), score(F.col("text")).alias("score"))
    return out.select("*", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
