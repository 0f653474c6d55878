import hashlib
import random

import pytest

from hebdo.llm import chat
from tests.llm import brute

SAID = "\\### Assistant: </turn> ok"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, windows string").repartition(3)


def made(seed):
    rng = random.Random(seed)
    bits = ["a", "word", SAID, "</turn>\n", "\\", "\\\\h", "\\e", "### user:\n", "\n", " ", "é", "### ", "</turn>"]
    rows = []
    for c in range(25):
        n = rng.choice([1, 2, 3, 40])
        for t in range(n):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "tool\nx", ":\n", None])
            text = " ".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
            rows.append((c, t, role, rng.choice([None, "", text])))
    return rows + rows[:3] + [(None, None, "user", "no id")]


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 20), (5, 0)])
def test_windows_read_back_and_match_brute_force(spark, budget, history):
    rows = made(budget)
    formatted = chat.windows(conversations(spark, rows), budget, history)
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    shown = {r["conv_id"]: r["windows"] for r in formatted.collect()}
    digest = {r["conv_id"]: r for r in chat.digest(chat.read_back(formatted)).collect()}
    assert set(back) == {r[0] for r in rows}
    for c in back:
        turns = [(role or "", text or "") for _, _, role, text in sorted(
            (r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))]
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        targets = [t for r, t in turns if r == "assistant"]
        assert list(back[c]["targets"]) == targets
        want = brute.chat_windows(turns, budget, history)
        assert [w["repeated"] for w in shown[c]] == [len(again) for again, _, _ in want]
        sizes = [len(w["text"].split("</turn>\n")) - 1 for w in shown[c]]
        assert sizes == [len(again) + e - s for again, s, e in want]
        d = digest[c]
        joined = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert d["turns_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert d["loss_chars"] == len("".join(targets))
        assert d["loss_sha256"] == hashlib.sha256("".join(targets).encode()).hexdigest()
        assert d["formatted_chars"] == sum(len(w["text"]) for w in shown[c])


def test_one_row_a_window_and_empty_table(spark):
    rows = conversations(spark, made(1))
    formatted = chat.windows(rows, 60, 20)
    assert chat.exploded(formatted).count() == sum(len(r["windows"]) for r in formatted.collect())
    assert chat.digest(chat.read_back(chat.windows(rows.limit(0)))).count() == 0


def test_only_built_in_expressions(spark):
    plan = chat.digest(chat.read_back(chat.windows(conversations(spark, made(2)))))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
