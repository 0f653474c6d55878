"""Decontamination with a benchmark of several passes and items that are cut into pieces."""

import random

import pytest

from hebdo.llm import decontaminate as dc
from tests.llm import brute

KEYS = ("n_words", "n_hit", "n_items", "items_sha256")


def tables(spark, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcde", k=3))
    items = [(f"i{k}", " ".join(word() for _ in range(rng.choice([3, 12, 40])))) for k in range(40)]
    long = [word() for _ in range(3000)]
    items += [("long", " ".join(long)), ("lost", " ".join(long[100:160])), ("i3", items[7][1]), ("none", "?!"), ("null", None)]
    docs = []
    for i in range(150):
        body = [word() for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            source = rng.choice(items)[1] or ""
            at = rng.randrange(0, max(1, len(source.split()) - 9))
            body[len(body) // 2:len(body) // 2] = source.split()[at:at + rng.choice([9, 10, 11, 30])]
        docs.append((i, " ".join(body)))
    docs += [(None, " ".join(long)), (5, " ".join(long[20:50])), (5, None), (6, "")]
    return docs, items


@pytest.mark.parametrize("pass_bytes,piece", [(1 << 20, 32_768), (3_000, 200), (700, 25)])
def test_passes_and_pieces_change_nothing(spark, monkeypatch, pass_bytes, piece):
    docs, items = tables(spark)
    monkeypatch.setattr(dc, "PIECE_WORDS", piece)
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id int, text string, row_number int").repartition(3)
    b = spark.createDataFrame(items, "item_id string, text string")
    hits = dc.benchmark_hits(d, b, item_block_bytes=pass_bytes)
    got = [(str(r["doc_id"]), *(r[k] for k in KEYS)) for r in dc.hit_digest(hits, ["doc_id", "row_number"]).collect()]
    want = [(str(i), *w) for (i, _), w in zip(docs, brute.decontamination([t for _, t in docs], items))]
    assert sorted(got) == sorted(want)
    clean = dc.decontaminate(d, b, item_block_bytes=pass_bytes)
    assert clean.columns == d.columns and clean.count() == sum(w[2] == 0 for w in want)


def test_the_driver_holds_the_items_of_one_pass(spark, monkeypatch):
    docs, items = tables(spark, 4)
    held = []
    plain = dc._with_state
    monkeypatch.setattr(dc, "_with_state", lambda d, part, *a, **k: (held.append(sum(len(t) for _, t in part)),
                                                                      plain(d, part, *a, **k))[1])
    monkeypatch.setattr(dc, "PIECE_WORDS", 100)
    monkeypatch.setattr(dc, "compile_patterns", None)            # tables are built in tasks, not here
    d = spark.createDataFrame(docs, "doc_id int, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    dc.benchmark_hits(d, b, item_block_bytes=2_000)
    assert len(held) > 5 and max(held) <= 3 * 2_000 and sum(held) >= sum(len(t or "") for _, t in items) * 0.9
