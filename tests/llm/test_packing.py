from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitsync.llm import packing

SIZE = 1024


def reference_ids():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text_equal_the_json_form(text):
    text = text.encode("utf-8", "ignore").decode()
    got = np.frombuffer(packing.tokenizer(packing.vocabulary())(text), "<u4").tolist()
    assert got == _IDS(text)


_IDS = reference_ids()


def check(rows, placed):
    """Every document's ids are covered once, cut as told, placed without gaps, whole."""
    want = {}
    for key, text in rows:
        ids = _IDS(text or "") + [2]
        start, stop = 0, (len(ids) - 1) % SIZE + 1
        pieces = []
        while start < len(ids):
            raw = np.array(ids[start:stop], "<u4").tobytes()
            pieces.append((len(pieces), start, stop - start, zlib.crc32(raw)))
            start, stop = stop, stop + SIZE
        want.setdefault(key, []).extend(pieces)
    got, bins = {}, {}
    for r in placed:
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= SIZE
    return len(bins), sum(p[2] for v in want.values() for p in v)


def test_documents_are_packed_whole_and_tightly(documents, texts):
    bins, tokens = check(list(texts.items()), packing.pack_documents(documents).collect())
    assert bins <= 1.05 * -(-tokens // SIZE)


def test_odd_texts_and_several_groups(make_docs):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, "<|endoftext|> x"), (4, "word " * 5000), (None, "no id"), (None, "no id"), (5, "twice"), (5, "twice")]
    rows += [(k, " ".join(rng.choice(["a", "be", "see", "déjà"]) for _ in range(rng.randrange(400)))) for k in range(10, 150)]
    rows += [(200, "x " * 1022 + "x"), (201, "x " * 1023 + "x")]
    check(rows, packing.pack_documents(make_docs(rows), per_group=30).collect())
    assert packing.pack_documents(make_docs([])).count() == 0


def test_search_beats_best_fit_and_only_raises_squared_fill(monkeypatch):
    rng = np.random.default_rng(5)
    improve = packing._improve
    for low, high in ((1, 700), (300, 420), (200, 600), (1000, 1025), (1, 3)):
        lengths = rng.integers(low, high, 3000)
        monkeypatch.setattr(packing, "_improve", lambda *a: None)
        plain = packing.pack(lengths, SIZE)
        monkeypatch.setattr(packing, "_improve", improve)
        bins = packing.pack(lengths, SIZE)
        assert sorted(i for b in bins for i in b) == list(range(3000))
        fills, before = [int(lengths[b].sum()) for b in bins], [int(lengths[b].sum()) for b in plain]
        assert max(fills) <= SIZE and len(bins) <= len(plain)
        assert sum(f * f for f in fills) >= sum(f * f for f in before)
    assert packing.pack(np.zeros(0, np.int64), SIZE) == []
    # 520 + 500 and 504 + 500 leave gaps; exchanging and moving fills two bins of three
    bins = packing.pack(np.array([700, 350, 330, 324, 320]), SIZE)
    assert len(bins) == 2


def test_added_tokens_in_texts_have_the_ids_of_the_json_form():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.ADDED == {t.content: k for k, t in plain.get_added_tokens_decoder().items()}
    encode = packing.tokenizer(packing.vocabulary())
    mark = "<|endoftext|>"
    for text in (f"{mark} x", mark, mark * 3, f"a {mark}  b\n{mark}", f"<|{mark}|>", "<|endoftext|", "<|ENDOFTEXT|>", f"é{mark}é  {mark} \n"):
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_a_text_of_two_million_blanks_is_encoded(make_docs):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.tokenizer(packing.vocabulary())
    text = "a" + " " * 2_000_000 + "b"
    want = plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode(text), "<u4").tolist() == want
    placed = packing.pack_documents(make_docs([(1, text), (2, "c")])).collect()
    assert sum(r["length"] for r in placed if r["doc_id"] == 1) == len(want) + 1
