"""Ranked lexical search against scores of every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from hebdo.llm import ranked_search as rs
from hebdo.llm.bytescan import ALNUM_WORDS, Words, same_bytes
from tests.llm.brute import words as word_list


def brute(docs, items, top=20):
    """docs, items: (id, text) -> sorted (item id, rank, doc id, score)."""
    bags = [(i, word_list(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for i, w in bags:
            if not w:
                continue
            tf, m = Counter(w), 75 + 25 * len(w) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in word_list(text) if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scored)[:top], 1):
            out.append((str(item), rank, None if none else i, -s))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id int, text string")
    rows = rs.ranked_search(d, q, **options).collect()
    return sorted(((str(r["item_id"]), r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    pool = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(pool, k=rng.choice([1, 5, 30, 200])))) for i in range(700)]
    docs += [(700 + i, docs[3][1]) for i in range(60)] + [(9, docs[9][1])] * 3
    docs += [(None, docs[4][1]), (None, docs[4][1]), (800, None), (801, ""), (802, "?! ..."),
             (803, "W1 w2\x00É w3 " * 30_000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([1, 4, 40])))) for i in range(25)]
    items += [(3, items[4][1]), (None, docs[3][1]), (90, ""), (91, None), (92, "--"), (93, "nowhere"),
              (94, "É w1 w1 W1")]
    return docs, items


@pytest.mark.parametrize("short,step", [(1 / 64, 2048), (0.0, 7), (1.0, 50)])
def test_equals_brute_force(spark, corpus, short, step, monkeypatch):
    if short == 1 / 64:
        assert run(spark, *corpus) == brute(*corpus)
    # the block search alone, with lists forced to either side and small steps
    monkeypatch.setattr(rs, "STEP", step)
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 400))
        lists = []
        for _ in range(int(rng.integers(1, 9))):
            docs = np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3, 0.9]))
            if len(docs):
                lists.append((docs, rng.integers(0, 6, len(docs)) * int(rng.choice([1, 50]))))
        few = [x for x in lists if len(x[0]) <= n * max(short, 0.05)]
        its = [rs._Iterator(*x) for x in lists if len(x[0]) > n * max(short, 0.05)]
        if few:
            its.append(rs.accumulators(few))
        best, ids = rs.Best(20), rng.permutation(n)
        rs.search_block(its, n, best, ids, np.zeros(n, bool))
        total = np.zeros(n, np.int64)
        for d, g in lists:
            total[d] += g
        want = sorted((-int(s), int(i)) for s, i in zip(total, ids) if s > 0)[:20]
        assert list(zip((-best.score).tolist(), best.id.tolist())) == want


def test_items_in_several_passes_and_small_blocks(spark, corpus):
    docs, items = corpus
    assert run(spark, docs, items, item_bytes=900) == brute(docs, items)
    assert run(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []


def test_words_of_equal_hash_are_told_apart(spark):
    twins = ["a", "b"]
    for _ in range(11):                                # Thue-Morse words: their polynomial hashes meet
        twins = [twins[0] + twins[1], twins[1] + twins[0]]
    docs = [(1, twins[0]), (2, twins[1]), (3, twins[0] + " x")]
    items = [(1, twins[0]), (2, twins[1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_same_bytes():
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab", k=rng.randrange(0, 40))) for _ in range(300)] + ["abcdefgh" * 3, "abcdefgh" * 3]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    end = np.cumsum([len(t) for t in texts])
    start = end - [len(t) for t in texts]
    i, j = (x.ravel() for x in np.indices((len(texts), len(texts))))
    got = same_bytes(data, start[i], end[i], data, start[j], end[j])
    assert got.tolist() == [texts[a] == texts[b] for a, b in zip(i, j)]
    assert len(Words(data, np.array([0, len(data)]), ALNUM_WORDS)) == 1


def test_columns_of_other_names_are_not_read(spark):
    d = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id int, text string, score int, rank int, item int")
    q = spark.createDataFrame([("x", "b", 1)], "item_id string, text string, doc_id int")
    assert [tuple(r)[:3] for r in rs.ranked_search(d, q).collect()] == [("x", 1, 1)]
