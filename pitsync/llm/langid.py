"""Language identification by words, with backoff to shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitsync.llm.staging import stage

#: A word: letters with the marks that combine with them.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Log frequency of every known unit per language.

    ``tables[0]`` holds whole words, ``tables[n]`` character n-grams; each maps a unit to
    its row in ``logs``.
    """

    languages: list[str]
    tables: list[dict[str, int]]
    logs: list[np.ndarray]


def units(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; the word itself for n = 0."""
    if not n:
        return [word]
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counts(longest: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: Counter = Counter()
            for lang, texts in frame.groupby("lang")["text"]:
                own: Counter = Counter()
                for text in texts:
                    own.update(WORD.findall(text.lower()))
                for word, times in own.items():
                    for n in range(longest + 1):
                        for unit in units(word, n):
                            seen[lang, n, unit] += times
            if seen:
                keys = list(seen)
                yield pd.DataFrame(
                    {
                        "lang": [k[0] for k in keys],
                        "n": [k[1] for k in keys],
                        "unit": [k[2] for k in keys],
                        "times": list(seen.values()),
                    }
                )

    return run


def choose(labelled: DataFrame, docs_per_language: int, bytes_per_language: int) -> DataFrame:
    """(pick, hash, lang) of the texts to learn from, one row per chosen text and language.

    ``labelled`` has (doc_id, hash, bytes, lang). Texts count once, however often they are
    repeated: a language gets at most ``docs_per_language`` of them, the first by hash, up
    to the one with which they reach ``bytes_per_language``. ``pick`` is a document that
    has the text.
    """
    texts = labelled.groupBy("lang", "hash").agg(F.min("doc_id").alias("pick"), F.max("bytes").alias("bytes"))
    first = Window.partitionBy("lang").orderBy("hash")
    ranked = texts.select("*", F.row_number().over(first).alias("at")).where(F.col("at") <= docs_per_language)
    before = F.coalesce(F.sum("bytes").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranked.select("*", before.alias("before")).where(F.col("before") < bytes_per_language).select("pick", "hash", "lang")


def fit(
    docs: DataFrame, docs_per_language: int = 1500, bytes_per_language: int = 24_000_000, longest: int = 4, least: int = 2, smoothing: float = 0.5
) -> LanguageModel:
    """Learn from the non-null (text, lang) of ``docs`` (doc_id, text, lang).

    The classifier is fit on whole distinct texts, at most ``docs_per_language`` and about
    ``bytes_per_language`` of each language (see ``choose``), and keeps units seen at least
    ``least`` times in them; these bound what reaches the driver. Hashes of texts are
    shuffled, and only the chosen texts are fetched, by a join with a table of at most
    ``docs_per_language`` rows a language. All else covers every document.
    """
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("hash"))
    chosen = stage(choose(labelled.select("doc_id", "hash", "lang", F.octet_length("text").alias("bytes")), docs_per_language, bytes_per_language), "language-sample")
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], [{} for _ in range(longest + 1)], [np.zeros((0, 0), np.float32)] * (longest + 1))
    wanted = F.broadcast(chosen.select("pick", F.col("hash").alias("chosen_hash"), F.col("lang").alias("chosen_lang")))
    same = (F.col("hash") == F.col("chosen_hash")) & (F.col("lang") == F.col("chosen_lang")) & F.col("doc_id").eqNullSafe(F.col("pick"))
    sample = labelled.join(wanted, same).dropDuplicates(["hash", "lang"]).select("text", "lang")
    seen = sample.mapInPandas(_counts(longest), "lang string, n int, unit string, times long")
    kept = seen.groupBy("n", "unit", "lang").agg(F.sum("times").alias("times"))
    kept = kept.groupBy("n", "unit").agg(F.map_from_entries(F.collect_list(F.struct("lang", "times"))).alias("by"), F.sum("times").alias("all")).where(F.col("all") >= least)
    table = kept.select("n", "unit", *[F.coalesce(F.col("by")[x], F.lit(0)).alias(f"c{i}") for i, x in enumerate(languages)]).toPandas()
    tables, logs = [], []
    for n in range(longest + 1):
        part = table[table["n"] == n]
        counts = part.iloc[:, 2:].to_numpy(np.float64) + smoothing
        tables.append({u: i for i, u in enumerate(part["unit"])})
        logs.append(np.log(counts / np.maximum(counts.sum(axis=0), 1)).astype(np.float32) if len(part) else np.zeros((0, len(languages)), np.float32))
    return LanguageModel(languages, tables, logs)


class Scorer(dict):
    """Scores words by a model and remembers their rows for as long as there are not too many."""

    def __init__(self, model: LanguageModel, remember: int = 200_000) -> None:
        super().__init__(model.tables[0])
        self.model, self.last = model, len(model.tables[0]) + remember
        self.rows = np.zeros((self.last, max(1, len(model.languages))), np.float32)
        self.rows[: len(model.tables[0]), : len(model.languages)] = model.logs[0]

    def __missing__(self, word: str) -> int:
        """The row of a word that is not known: the mean over its longest known n-grams."""
        if len(self) == self.last:
            self.clear()
            self.update(self.model.tables[0])
        row = len(self)
        self.rows[row] = 0
        for n in range(len(self.model.tables) - 1, 0, -1):
            get = self.model.tables[n].get
            grams = [r for r in map(get, units(word, n)) if r is not None]
            if grams:
                self.rows[row] = np.add.reduce(self.model.logs[n][grams]) / len(grams)
                break
        self[word] = row
        return row

    def word(self, word: str) -> np.ndarray:
        """Log frequency of a word per language."""
        return self.rows[self[word]]

    def text(self, text: str | None) -> tuple[str, float]:
        """The most likely language (the first by name of equals) and its share of the probability."""
        counts = Counter(WORD.findall(text.lower())) if text else None
        if not counts or not self.model.languages:
            return UNDETERMINED, 0.0
        times = np.fromiter(counts.values(), np.float64, len(counts))
        total = np.zeros(len(self.model.languages))
        words = list(counts)
        for i in range(0, len(words), 10_000):  # rows are good until the next clearing
            part = words[i : i + 10_000]
            if len(self) + len(part) > self.last:
                self.clear()
                self.update(self.model.tables[0])
            total += times[i : i + 10_000] @ self.rows[[self[w] for w in part]].astype(np.float64)
        # words of a text are not independent: evidence grows with the root of their number
        total /= math.sqrt(times.sum())
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(odds[best] / odds.sum())


def predictor(model: LanguageModel, spark) -> object:
    """A column function from a text to (lang_pred, score), with the model sent once."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pd.DataFrame([scorer.text(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def holdout(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out part; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from documents that are not held out (crc32 of doc_id mod 3 is 1) and have a
    lang. A text that is null or has no letter gets ``und`` and 0, as does every text if
    there is nothing to learn from. Rows are independent: repeated ones get equal results,
    and a text is learned from once per language, whatever its copies.
    """
    held = holdout(F.col("doc_id"), 3, 1)
    model = fit(docs.where(~held), **options)
    predict = predictor(model, docs.sparkSession)
    out = docs.select("doc_id", held.alias("held_out"), predict(F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, least_score: float = 0.5, **options: object) -> DataFrame:
    """The documents with a language of at least ``least_score``, with all columns."""
    model = fit(docs.where(~holdout(F.col("doc_id"), 3, 1)), **options)
    p = predictor(model, docs.sparkSession)(F.col("text"))
    return docs.where((p["lang_pred"] != UNDETERMINED) & (p["score"] >= least_score))
