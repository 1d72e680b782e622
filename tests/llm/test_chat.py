from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from satlake.llm import chat, oracles
from satlake.llm.queries import op5_chat
from tests.oracle import both, connect

LOG = "conv bigint, seq bigint, turn bigint, kind string, role string, text string"


def turns(spark, log):
    m = chat.fold(spark.createDataFrame(log, LOG))
    return sorted(((r.conv, r.turn, r.role, r.text) for r in m.collect()), key=repr)


def test_fold(spark):
    log = [
        (1, 3, 0, "delta", None, " world"), (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "hello"),
        (1, 4, 1, "open", "assistant", None), (1, 5, 1, "delta", None, "bad"), (1, 6, 1, "regenerate", None, None), (1, 7, 1, "delta", None, "go"), (1, 8, 1, "delta", None, "od"), (1, 9, 1, "ping", None, "x"), (1, 9, 1, None, None, "x"),
        (1, 10, 2, "open", "user", None), (1, 11, 2, "delta", None, "typo"), (1, 12, 2, "edit", None, "fixed"), (1, 13, 2, "delta", None, "!"),
        (1, 14, 3, "open", "user", None), (1, 15, 3, "drop", None, None), (2, 1, None, "delta", None, None),
    ]
    assert turns(spark, log) == [(1, 0, "user", "hello world"), (1, 1, "assistant", "good"), (1, 2, "user", "fixed!"), (2, None, "", "")]
    assert turns(spark, []) == []


NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|assistant|>\nhi", "\\", "\\l\\k\\b\\p", "<", "", None, "\n\n", "é🎉<|end|>", "a" * 5000, "|>\n", "<|user|>\n"]


@pytest.mark.parametrize("role", ["user", "assistant", "sys|>\ntem", None, "", "<|end|>\n"])
def test_round_trip(spark, role):
    table = [(9, k, role, t) for k, t in enumerate(NASTY)] + [(9, 3, "assistant", "tie"), (9, 3, "assistant", "tie"), (9, None, "user", "first"), (None, 1, role, "no conversation")]
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    out = chat.render(chat.fold(chat.log_of(df)))
    got = {r.conv: r for r in out.select("conv", "formatted", "loss_mask", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    own = sorted((r for r in table if r[0] == 9), key=order)
    assert [(t["role"], t["text"]) for t in got[9].turns] == [(r[2] or "", r[3] or "") for r in own]
    assert got[9].loss == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[9].formatted.count("<|end|>\n") == len(own) and len(got) == 2
    for control in ("</s>", "[INST]", "[/INST]", "<<SYS>>"):
        assert control not in got[9].formatted


def test_mask_spans(spark):
    df = spark.createDataFrame([(1, 0, "user", "a<b"), (1, 1, "assistant", "x[1]<🎉"), (1, 2, "assistant", "")], "conv_id bigint, turn bigint, role string, text string")
    r = chat.render(chat.fold(chat.log_of(df))).first()
    parts = r.formatted.split("<|end|>\n")
    texts = [parts[m["turn"]][m["start"] : m["end"]] for m in r.loss_mask]
    assert texts == ["x\\k1]\\l🎉", ""]


def test_all_kinds_are_staged(spark, sf):
    """The log of a table holds edits, regenerations and dropped messages, and folds into the table."""
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    log = chat.log_of(df)
    assert {r.kind for r in log.select("kind").distinct().collect()} == set(chat.KINDS)
    assert log.where("kind = 'drop'").count() == df.select("conv_id").distinct().count()
    assert chat.fold(log).count() == df.count()


def test_clashing_columns_and_long_texts(spark):
    """Extra columns of names that are used inside change nothing; a turn of 300,000 characters, half of them escaped, comes back whole."""
    long = "<[\\" * 50_000 + "é🎉 x" * 37_500
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", long), (2, 0, "assistant", "ok")], "conv_id bigint, turn bigint, role string, text string")
    clash = df.select("*", *[F.lit(7).alias(c) for c in ("conv", "seq", "kind", "n", "e", "events", "reset", "turns", "learn", "body", "head", "formatted", "loss_mask", "loss")])
    for table in (df, clash):
        out = chat.render(chat.fold(chat.log_of(table))).select("conv", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss_mask")).alias("loss"))
        got = {r.conv: ([(t["role"], t["text"]) for t in r.turns], r.loss) for r in out.collect()}
        assert got == {1: ([("user", "q"), ("assistant", long)], long), 2: ([("assistant", "ok")], "ok")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.render(chat.fold(chat.log_of(df))).collect() == []


def test_query(spark, sf):
    df = op5_chat(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    ours, theirs = both(df, connect(sf), oracles.chats())
    assert ours == theirs
    odd = "</s>[INST] ok [/INST]"
    r = df.where("conv_id = -7").first()
    assert r.n_turns == 2 and r.turns_sha256 == sha256(f"user\n{odd}\nassistant\n{odd}\n".encode()).hexdigest()
    assert r.loss_chars == len(odd) and r.loss_sha256 == sha256(odd.encode()).hexdigest()
