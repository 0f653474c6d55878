"""Conversations of any length, and rows without a conversation id."""

import random

from pyspark.sql import functions as F

from hebdo.llm import chat
from tests.llm import brute
from tests.llm.test_chat import conversations


def test_rows_without_an_id_are_conversations_of_one_turn(spark):
    rows = [(None, i % 3, ["user", "assistant", "system", None][i % 4], f"text {i % 5}") for i in range(60)]
    rows += [(None, None, "assistant", None), (1, 0, "assistant", "x"), (1, None, "user", "first")]
    df = conversations(spark, rows)
    back = chat.digest(chat.read_back(chat.windows(df, 20, 8))).collect()
    loose = [r for r in back if r["conv_id"] is None]
    assert len(back) == 62 and {r["n_turns"] for r in loose} == {1}
    assert sum(r["loss_chars"] for r in loose) == sum(len(t or "") for c, _, r, t in rows if c is None and r == "assistant")
    shown = chat.window_rows(df, 20, 8).where("conv_id is null").collect()
    assert len(shown) == 61 and all(r["window"] == 0 and r["repeated"] == 0 and r["text"].endswith("</turn>\n") for r in shown)
    # no exchange by the missing id: the rows are formatted where they are
    plan = chat._loose_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" not in plan


def test_a_conversation_of_a_hundred_thousand_turns(spark):
    n, budget, history = 100_000, 1024, 256
    rows = spark.range(n).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "system").when(F.col("id") % 2 == 1, "user").otherwise("assistant").alias("role"),
        F.expr("array_join(transform(sequence(0, cast(pmod(xxhash64(id), 60) as int)), x -> concat('w', x)), ' ')").alias("text"))
    turns = [(r["role"], r["text"]) for r in rows.orderBy("turn").collect()]
    want = brute.chat_windows(turns, budget, history)
    got = chat.window_rows(rows.repartition(8), budget, history).select(
        "window", "repeated", F.size(F.split("text", "</turn>\n")).alias("n"), F.size("loss").alias("targets"))
    found = {r["window"]: (r["repeated"], r["n"] - 1, r["targets"]) for r in got.collect()}
    assert found == {k: (len(again), len(again) + e - s, sum(turns[i][0] == "assistant" for i in range(s, e)))
                     for k, (again, s, e) in enumerate(want)}
    d = chat.digest(chat.read_back(chat.windows(rows, budget, history))).first()
    targets = [t for r, t in turns if r == "assistant"]
    assert d["n_turns"] == n and d["loss_chars"] == len("".join(targets))


def test_only_counts_of_a_conversation_share_a_row_before_its_windows(spark):
    rng = random.Random(1)
    df = conversations(spark, [(i % 3, i, "user", "x" * rng.randint(1, 9)) for i in range(90)])
    spans = chat.spans(chat.turns(df), 20, 8)
    assert spans.columns == ["conv_id", "sys", "window", "s", "e", "h"]
    plan = spans._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(i" in plan and "collect_list(struct(i, text" not in plan
