"""Personal data: base patterns, and spans found by a character BiLSTM-CRF."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitsync.llm import bilstm_crf

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Stretches that hold every match: emails have no white space, the others these characters.
TOKEN_WITH_AT = re.compile(r"[A-Za-z0-9._%+@-]*@[A-Za-z0-9._%+@-]*")
NUMERIC = re.compile(r"[0-9+][\x20().0-9+-]*")

Span = tuple[int, int, int]  # start, end, number of the kind


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: int, found: str) -> bool:
    digits = "".join(c for c in found if c in "0123456789")
    if kind == 1:
        return all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in found.split("."))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 9 <= len(digits) <= 15
    return True


def base_spans(text: str, checksum: bool = True) -> list[Span]:
    """Spans of the base patterns, by start, then kind; with ``checksum`` false also cards
    of the right length that fail Luhn."""
    spans = []
    if "@" in text:
        for token in TOKEN_WITH_AT.finditer(text):
            spans += [(m.start(), m.end(), 0) for m in EMAIL.finditer(text, token.start(), token.end())]
    for run in NUMERIC.finditer(text):
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            for m in pattern.finditer(text, run.start(), run.end()):
                if valid(kind, m.group()) or not checksum and kind == 2 and 12 <= sum(c.isdigit() for c in m.group()) <= 19:
                    spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], s[2]))


#: Characters by class: 0 pads, then digits, lower and upper case, other white space,
#: what is beyond ASCII, and each other ASCII character by itself.
_CLASS = np.full(128, 4, dtype=np.int64)
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 1, 2, 3
_CLASS[[c for c in range(32, 127) if not chr(c).isalnum()]] = np.arange(6, 6 + 33)
CHARS, TAGS = 6 + 33, 1 + 2 * len(KINDS)
#: Window length and step, and how far a window reaches beyond a digit or an @.
LENGTH, STEP, REACH = 64, 32, 16
TRIGGER = re.compile("[0-9@]+")


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 5)


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all of the text within ``REACH`` of a digit or an @.

    Every kind of span has one, so all else is outside of spans by definition.
    """
    areas: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        low, high = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if areas and low <= areas[-1][1]:
            areas[-1][1] = high
        else:
            areas.append([low, high])
    out = []
    for low, high in areas:
        at = low
        while True:
            out.append((at, min(at + LENGTH, high)))
            if at + LENGTH >= high:
                break
            at += STEP
    return out


def _input(text_classes: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    x = np.zeros((len(spans), LENGTH), dtype=np.int64)
    for k, (a, b) in enumerate(spans):
        x[k, : b - a] = text_classes[a:b]
    return x


def training_set(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the tags of their labelled spans: outside 0, begin 1 + 2 k, inside 2 + 2 k.

    Where spans overlap, the one that begins first counts. No tagger of characters can learn
    a checksum, so card numbers are labelled by their form; what it proposes is checked.
    """
    xs, ys = [], []
    for text in texts:
        tags = np.zeros(len(text), dtype=np.int64)
        for start, end, kind in base_spans(text, checksum=False):
            if not tags[start:end].any():
                tags[start:end] = 2 + 2 * kind
                tags[start] = 1 + 2 * kind
        found = windows(text)
        if found:
            xs.append(_input(classes(text), found))
            y = np.zeros((len(found), LENGTH), dtype=np.int64)
            for k, (a, b) in enumerate(found):
                y[k, : b - a] = tags[a:b]
            ys.append(y)
    if not xs:
        return np.zeros((0, LENGTH), np.int64), np.zeros((0, LENGTH), np.int64)
    return np.concatenate(xs), np.concatenate(ys)


def fit(docs: DataFrame, max_docs: int = 1200, max_windows: int = 4000, **options: object) -> bilstm_crf.Params:
    """Train on about ``max_docs`` documents with a digit or an @, picked by a hash of
    their text, labelled by the base patterns; of their windows the first ``max_windows``
    in an order by hash. Only the tagger's fit is bounded; finding covers all texts."""
    marked = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    share = max(1, marked.count() // max_docs)
    sample = marked.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).distinct().toPandas()
    texts = sorted(sample["text"], key=lambda t: hashlib.md5(t.encode("utf-8", "replace")).digest())
    x, y = training_set(texts)
    if not len(x):
        return bilstm_crf.new_params(CHARS, TAGS, 4, 0)
    # identical windows, of copied documents, teach nothing twice
    _, first = np.unique(np.concatenate([x, y], axis=1), axis=0, return_index=True)
    order = np.random.default_rng(3).permutation(np.sort(first))[:max_windows]
    return bilstm_crf.train(x[order], y[order], CHARS, TAGS, **options)


def decode(p: bilstm_crf.Params, x: np.ndarray, batch: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of windows (window, position) and their probabilities."""
    tags, sure = [], []
    for i in range(0, len(x), batch):
        e, _ = bilstm_crf.emissions(p, x[i : i + batch])
        best = bilstm_crf.viterbi(p, e)
        prob, _, _ = bilstm_crf.marginals(p, e)
        tags.append(best.T)
        sure.append(np.take_along_axis(prob, best[:, :, None], axis=2)[:, :, 0].T)
    return np.concatenate(tags), np.concatenate(sure)


def reconcile(spans: list[tuple[int, int]], tags: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Spans (start, end, kind, mean probability) of a text from its decoded windows.

    A position that several windows decoded takes the tag of the one in which it lies
    farthest from an end; spans are then read from the joined tags.
    """
    best: dict[int, tuple[int, int, float]] = {}
    for (a, b), own, p in zip(spans, tags, sure, strict=True):
        for k in range(b - a):
            inner = min(k, b - a - 1 - k)
            if a + k not in best or inner > best[a + k][0]:
                best[a + k] = (inner, int(own[k]), float(p[k]))
    out: list[list] = []
    for at in sorted(best):
        _, tag, p = best[at]
        if not tag:
            continue
        kind, begins = (tag - 1) // 2, tag % 2 == 1
        if out and not begins and out[-1][1] == at and out[-1][2] == kind:
            out[-1][1] = at + 1
            out[-1][3].append(p)
        else:
            out.append([at, at + 1, kind, [p]])
    return [(a, b, k, float(np.mean(ps))) for a, b, k, ps in out]


#: What a found span has to look like, as a base match must: the tagger proposes, and
#: these keep numbers that only resemble personal data out.
SHAPES = (EMAIL, IP, CARD, re.compile(r"[+(]?[0-9][\x20().0-9-]+[0-9]"))


def added_spans(text: str, base: list[Span], found: list[tuple[int, int, int, float]], least: float) -> list[Span]:
    """Spans of the tagger that are sure enough, well-formed and apart from base spans."""
    out = []
    for start, end, kind, p in found:
        if p < least or any(start < b and a < end for a, b, _ in base):
            continue
        piece = text[start:end]
        whole = not (piece[0].isalnum() and text[start - 1 : start].isalnum() or piece[-1].isalnum() and text[end : end + 1].isalnum())
        if whole and SHAPES[kind].fullmatch(piece) and valid(kind, piece):
            out.append((start, end, kind))
    return out


def _shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_pii(docs: DataFrame, least: float = 0.5, **options: object) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and ``base_sha256`` are of the base patterns; ``spans`` holds them and
    those that the tagger adds with a mean probability of ``least`` or more: well-formed
    ones that overlap no base span, such as two card numbers that stand side by side.
    Places are code points, ends exclusive.

    A null or empty text has no spans. Rows are independent, repeated ones get equal
    results. A text of any length is read window by window, in bounded memory. An empty
    table gives an empty result; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, **options))

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = [t or "" for t in texts]
            base = [base_spans(t) for t in texts]
            added: dict[int, list[Span]] = {}
            held, size = [], 0
            for k, text in enumerate(texts):
                if own := windows(text):
                    held.append((k, own))
                    size += len(own)
                if held and (size >= 20_000 or k == len(texts) - 1):
                    added |= _tagged(sent.value, texts, base, held, least)
                    held, size = [], 0
            if held:
                added |= _tagged(sent.value, texts, base, held, least)
            rows = []
            for k, spans in enumerate(base):
                counts = [sum(s[2] == kind for s in spans) for kind in range(4)]
                digest = hashlib.sha256(_shown(spans).encode()).hexdigest()
                rows.append((*counts, digest, _shown(spans + added.get(k, []))))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    out = docs.select("doc_id", find(F.col("text")).alias("p"))
    return out.select("doc_id", *[f"p.{c.split()[0]}" for c in FOUND.split(", ")])


def _tagged(p: bilstm_crf.Params, texts: list[str], base: list[list[Span]], held: list[tuple[int, list]], least: float) -> dict[int, list[Span]]:
    """Added spans by text, for the windows of several texts decoded together."""
    x = np.concatenate([_input(classes(texts[k]), own) for k, own in held])
    tags, sure = decode(p, x)
    out, at = {}, 0
    for k, own in held:
        part = slice(at, at + len(own))
        out[k] = added_spans(texts[k], base[k], reconcile(own, tags[part], sure[part]), least)
        at += len(own)
    return out
