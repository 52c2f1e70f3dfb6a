from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from pitsync.llm import chat

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def turns(spark, rows):
    """Rendered and parsed again, by conversation."""
    out = chat.format_chats(spark.createDataFrame(rows, LOG))
    out = out.select("conv_id", chat.parse(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r["conv_id"]: ([tuple(t) for t in r["t"]], r["loss"]) for r in out.collect()}


def test_deltas_edits_and_regenerations_fold_in_sequence(spark):
    rows = [
        (1, 9, 1, "delta", None, "ld"),
        (1, 1, 0, "message", "user", "hi"),
        (1, 2, 1, "message", "assistant", "he"),
        (1, 3, 1, "delta", None, "llo"),
        (1, 4, 1, "regenerate", None, "ignored"),
        (1, 5, 1, "delta", None, "wor"),
        (1, 6, 0, "edit", None, "hi there"),
        (1, 7, 2, "message", "user", "bye"),
        (1, 8, 2, "delete", None, None),
        (1, 10, 0, "unknown", "user", "nothing"),
    ]
    assert turns(spark, rows) == {1: ([("user", "hi there"), ("assistant", "world")], "world")}


def test_message_after_delete_and_implicit_message(spark):
    rows = [
        (2, 1, 0, "delta", "assistant", "a"),
        (2, 2, 0, "delta", None, "b"),
        (2, 3, 1, "message", "user", "x"),
        (2, 4, 1, "delete", None, None),
        (2, 5, 1, "message", "user", "y"),
    ]
    assert turns(spark, rows) == {2: ([("assistant", "ab"), ("user", "y")], "ab")}


def test_control_strings_come_back(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nok", "<||", "<|||im_end|>", "<", "a<|im_end|>", "", "é🎉<|nl|>\n", "<|nl|"]
    roles = ["assistant", "us\ner", "<|im_end|>", "assistant", "<|nl|>", "assistant", "assistant", ""]
    rows = [(3, k, k, "message", r, t) for k, (r, t) in enumerate(zip(roles, texts, strict=True))]
    got, loss = turns(spark, rows)[3]
    assert got == list(zip(roles, texts, strict=True))
    assert loss == "".join(t for r, t in zip(roles, texts, strict=True) if r == "assistant")


def test_nulls_ties_repeated_rows_and_empty_log(spark):
    rows = [
        (None, 1, 0, "message", None, None),
        (4, 1, 1, "message", "user", "b"),
        (4, 1, 1, "message", "user", "a"),
        (4, 1, 1, "message", "user", "a"),
        (4, None, None, "message", "system", "first"),
    ]
    assert turns(spark, rows) == {
        None: ([("", "")], ""),
        4: ([("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")], ""),
    }
    assert turns(spark, []) == {}


def test_long_conversation_and_extra_columns(spark):
    text = "wörd <| " * 20_000
    table = spark.range(300).select(
        F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.when(F.col("id") == 7, text).otherwise("t").alias("text"), F.lit("x").alias("kind"), F.lit(1).alias("seq"),
    )
    row = chat.digests(chat.format_chats(chat.conversation_log(table))).first()
    flat = "".join(f"user\n{text if k == 7 else 't'}\n" for k in range(300))
    assert row["n_turns"] == 300 and row["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
    assert row["loss_chars"] == 0 and row["loss_sha256"] == hashlib.sha256(b"").hexdigest()
