"""Batches and messages of the suffix-array dedup: hot ids, rows without ids, relays."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hebdo.llm import suffix_dedup as sd
from tests.llm import brute
from tests.llm.test_documents import frame

KEYS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def passages(seed, n, low=60, high=400):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcde fgh", k=rng.randint(50, 130))) for _ in range(12)]
    return ["".join(rng.choices("ijklm nop", k=rng.randint(low, high))) + rng.choice(pool)
            + "".join(rng.choices("qrst uvw", k=20)) + rng.choice(pool) for _ in range(n)]


def digest(spark, rows, **sizes):
    got = sd.digest(frame(spark, rows), **sizes).collect()
    return sorted(((r["doc_id"] is None, *(r[k] for k in KEYS)) for r in got), key=str)


def want(rows):
    loose = [(None, t) for i, t in rows if i is None]
    found = brute.suffix_dedup([r for r in rows if r[0] is not None])
    whole = [(None, *r[1:]) for r in brute.suffix_dedup([(0, t) for _, t in loose])]
    return sorted([(i[0] is None, *i) for i in found + whole], key=str)


def sizes_of_batches(docs, batch_bytes):
    dealt, name, _ = sd.batched(docs.where("doc_id is not null"), "doc_id", "text", batch_bytes)
    return [r["n"] for r in dealt.groupBy(name).agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()]


def test_an_id_of_a_third_of_all_rows(spark):
    texts = passages(1, 150)
    rows = [(7 if i % 3 == 0 else i, t) for i, t in enumerate(texts)] + [(7, texts[0])] * 60
    rows += [(2, texts[3]), (10 ** 15, texts[0] + texts[1]), (-4, texts[6])]
    size = sum(len(t) for _, t in rows)
    biggest = max(sizes_of_batches(frame(spark, rows), 2_000))
    assert biggest <= 4 * 2_000 + 1_000 < size / 4
    assert digest(spark, rows, batch_bytes=2_000, bucket_bytes=8_000) == want(rows)


def test_rows_without_an_id_take_no_part(spark):
    texts = passages(2, 60)
    rows = [(None if i % 3 else i, t) for i, t in enumerate(texts)] + [(None, None), (None, ""), (100, None)]
    assert digest(spark, rows, batch_bytes=2_000) == want(rows)
    docs = frame(spark, rows)
    kept = sd.without_repeats(docs, batch_bytes=2_000)
    assert kept.columns == docs.columns
    loose = sorted(str(r["text"]) for r in kept.where("doc_id is null").collect())
    assert loose == sorted(str(t) for i, t in rows if i is None)
    # all rows without an id: nothing is grouped by it
    nothing = frame(spark, [(None, t) for t in texts])
    assert sizes_of_batches(nothing, 1_000) == []
    assert sd.without_repeats(nothing).count() == 60


def test_ids_that_a_double_cannot_tell_apart(spark):
    base = 2 ** 62
    rows = [(base + i, t) for i, t in enumerate(passages(3, 60))]
    assert digest(spark, rows, batch_bytes=1_000) == want(rows)


@pytest.mark.parametrize("fan,buckets", [(2, 16), (4, 16), (8, 64), (4, 4)])
def test_relays_change_nothing(spark, fan, buckets):
    rows = [(i // 2, t) for i, t in enumerate(passages(4, 120))]
    assert digest(spark, rows, batch_bytes=1_500, buckets=buckets, fan=fan) == want(rows)


def test_messages_grow_with_the_input_not_with_its_square(spark, monkeypatch):
    counted = []
    direct = sd.Exchange.answered

    def counting(self, sent, layout, sort):
        counted.append(sent.count())
        return direct(self, sent, layout, sort)
    monkeypatch.setattr(sd.Exchange, "answered", counting)
    per_batch = {}
    for n in (60, 240):
        rows = [(i, t) for i, t in enumerate(passages(5, n))]
        size = sum(len(t) for _, t in rows)
        counted.clear()
        sd.digest(frame(spark, rows), batch_bytes=2_000, buckets=size // 500, fan=16)
        per_batch[n] = counted[0] / (size / 2_000)
    # a batch sends at most ``fan`` messages (the last batch of an id range is not full)
    assert per_batch[240] <= 1.1 * per_batch[60] and per_batch[240] <= 16 * 1.1


def test_two_hashes_of_a_window():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 4000, dtype=np.uint8)
    s = sd.Stretches(data, np.array([0, len(data)]), 50)
    _, start, digit = s.windows(np.arange(len(s)))
    assert digit.shape == (len(start), 2) and (digit[:, 0] != digit[:, 1]).all()
    kinds, place = sd._distinct(digit)
    assert len(kinds) == len({data[a:a + 50].tobytes() for a in start}) and (kinds[place] == digit).all()


def test_the_memory_of_a_batch_stays_near_its_text(spark, monkeypatch):
    """A batch of 4 MB once took 130 MB to mark what is removed, and as much again to take it out of the texts."""
    rng, line = random.Random(5), "of a passage that every third text has, as it is, and é between " * 3
    texts = ["".join(rng.choices("abcdefgh ij", k=2000)) + line * (i % 3 == 0) for i in range(2000)]
    table = pa.table({"doc_id": pa.array(range(2000), pa.int64()), "text": texts, "n_chars": [len(t) for t in texts]})
    made = []
    monkeypatch.setattr(sd, "repeated", lambda docs, doc_id, text, finish, *_, **__: made.append(finish) or docs)
    sd.without_repeats(frame(spark, [(1, "x")]))
    run, number = sd.Passes("doc_id", "text", sd.WINDOW, 4), {"cell": 0, "owner": 0, "cut": 0}

    def answered(sent, layout, sort):
        out = []
        for r in sent.to_pylist():
            bits = r["body"] if r["kind"] == sd.STATE else b"".join(
                map(sd._bits, sort([((0, 0), layout.read(r["body"]))])[0]))
            out.append((r["bucket"], r["batch"], sd.STATE if r["kind"] == sd.STATE else sd.ANSWER, bits))
        return sd._messages(out)

    mail = answered(run.send_grams(number, table), sd.GRAM_FIELDS, sd.sort_grams)
    mail = answered(run.send_stretches(number, table, mail), sd.STRETCH_FIELDS, sd.sort_stretches)
    mail = answered(run.send_windows(number, table, mail), sd.WINDOW_FIELDS, sd.sort_windows)
    tracemalloc.start()
    batch, gone = run.removed(table, mail)
    marked = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    kept = made[0](run, batch, gone, table).column("text").to_pylist()
    taken = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept[0] == texts[0] and len(kept[3]) < len(texts[3]) - 150 and kept[1] == texts[1]
    assert marked < 100e6 and taken < 100e6
