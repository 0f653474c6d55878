"""Vector code compression against integer arithmetic row by row."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from hebdo.llm import vector_codes as vc


def brute(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label) -> ({(id, code, error, label_error)} as a sorted list, digest)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[math.floor(Fraction(x) * 4096) for x in r[1]] for r in kept]
    w = len(cut[0]) // parts
    cut = [[tuple(c[p * w:(p + 1) * w]) for p in range(parts)] for c in cut]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                at = [c[p] for c, m in zip(cut, mine) if m == e]
                if at:
                    books[p][e] = tuple(sum(x) // len(at) for x in zip(*at))
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    top = (1 << 63) - 1
    errors = [min(sum(d for d, _ in f), top) for f in found]
    label = {}
    for r, e in zip(kept, errors):
        label[r[2]] = min(label.get(r[2], 0) + e, top)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{i:02x}" for _, i in f), e, label[r[2]])
                  for r, f, e in zip(kept, found, errors)), digest


def run(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")
    out = vc.vector_codes(df).collect()
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in out), \
        {r["codebooks_sha256"] for r in out}


def f32(x):
    return float(np.float32(x))


def test_equals_brute_force_with_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(3)
    rows = [(i, [f32(rng.choice([-0.5, 0.25, rng.gauss(0, 1)])) for _ in range(16)], rng.choice([1, 2, None]))
            for i in range(300)]
    rows += [rows[5]] * 40 + [(None, rows[7][1], 1), (1000, None, 2), (1001, [None] + [0.0] * 15, 2),
                              (1002, [math.nan] + [0.0] * 15, 2), (-5, [math.inf] + [0.0] * 15, None)]
    got, digests = run(spark, rows)
    want, digest = brute(rows)
    assert got == want and digests == {digest}


@pytest.mark.parametrize("scale", [1e6, 1e18, 1e300, 1.7e308])
def test_integers_of_any_size_are_exact(spark, scale):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * scale for _ in range(8)], 1) for i in range(60)]
    got, digests = run(spark, rows, "double")
    want, digest = brute(rows)
    assert got == want and digests == {digest}


def test_small_empty_and_wrong_tables(spark):
    assert run(spark, []) == ([], set())
    one = [(3, [0.5] * 8, None)]
    assert run(spark, one) == ([("3", "00" * 8, 0, 0)], {brute(one)[1]})
    assert run(spark, [(3, [], 1), (4, [], 1)])[0] == [("3", "00" * 8, 0, 0), ("4", "00" * 8, 0, 0)]
    for wrong in ([(1, [0.0] * 9, 1)], [(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)]):
        with pytest.raises(ValueError):
            run(spark, wrong)


def test_columns_of_other_names_are_not_read(spark):
    df = spark.createDataFrame([(i, [float(i)] * 8, "x", 1, 2, 3) for i in range(20)],
                               "vec_id bigint, embedding array<double>, label string, code int, error int, i int")
    assert vc.vector_codes(df).count() == 20


def test_many_labels_meet_by_a_shuffle(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i if i % 3 else None) for i in range(90)]
    monkeypatch.setattr(vc, "SMALL_LABELS", 5)
    monkeypatch.setattr(vc, "HOT_LABEL", 10)
    got, _ = run(spark, rows, "double")
    assert got == brute(rows)[0]


@pytest.mark.parametrize("subtree", [1, 3, 4096])
def test_trie_walk_equals_plain_distances(subtree, monkeypatch):
    monkeypatch.setattr(vc, "SUBTREE", subtree)
    rng = np.random.default_rng(6)
    part = rng.integers(-3, 3, (500, 5))
    leaves, place = vc.compile_trie(part)
    assert (leaves[place] == part).all() and len(leaves) == len(np.unique(part, axis=0))
    book = rng.integers(-3, 3, (16, 5))
    entry, least = vc.nearest(leaves, book)
    plain = ((leaves[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == plain.argmin(axis=1)).all() and (least == plain.min(axis=1)).all()
    wide, distance = vc.nearest(leaves.astype(object), book)
    assert (wide == entry).all() and (distance == least).all()
