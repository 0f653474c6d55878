"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A bag is a run of at most ``SEGMENT`` words of one text, each distinct word
once.  Its features are the byte n-grams (lengths ``GRAMS``, with
word-boundary marks) of its lower-cased words, hashed to buckets; the bag's
vector is the average of their embeddings (a bag with fewer than ``LEAST``
features is filled up with the zero vector) and a linear softmax over two
classes reads it.  Embeddings and softmax are
trained together in numpy by mini-batch Adagrad, so a misspelling that was
never seen still shares most of its n-gram vectors with its model word.  A
text scores as its most toxic bag, so a few words count as much in a long
text as in a short one.

Only documents are labelled, not bags.  Round one trains every bag with its
document's label; later rounds keep, of a toxic document, the bags that score
above nearly all bags of clean documents (its highest one at least).  The cut
weighs a missed toxic document like ``MISS`` false alarms.

Fitting uses at most about ``SAMPLE_ROWS`` labelled rows of each class, chosen
by a hash of the id (the documented bound), and all bags of their whole texts,
however long.  Spark cuts the texts into bags, deals each round's bags out in a
random order, as often as the round passes over them, and scores them between
rounds; one task of a round reads that stream and trains, holding the model and
one mini-batch at a time.  The driver gets the model.  A round passes over the
bags until it has seen ``bags_seen`` of them (a parameter of the fit), twice at
least and ``MOST_PASSES`` times at most.
Scoring covers every row and its whole text.

Cases: a null, empty or wordless text has no bag and gets the score of an
empty bag; null labels are ignored; repeated label rows of an id use the
smallest label, repeated document rows its smallest text; with one class only every score is 0.0; other columns may be
kept; ids are numbers or texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.bytescan import ALNUM_WORDS, LOWER, Words, mix, text_blocks
from hebdo.llm.names import check_free
from hebdo.session import materialize

SAMPLE_ROWS = 3_000             # of each class
SEGMENT = 12
GRAMS = (3, 4, 5, 6)
LEAST = 120
BITS = 17
DIM = 8
BAGS_SEEN = 160_000             # bags that each round trains on
MOST_PASSES = 24
ROUNDS = 3
MISS = 3
SNAPSHOT = 20                   # mini-batches between the models that a round averages
BATCH = 512
CUT = 0.3
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Hashed n-grams of the words of a block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(LOWER[data], offsets, ALNUM_WORDS)
        raw, begin = self.words.joined()
        self.buffer = np.frombuffer(b" " + raw, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        self.first = begin                                      # the mark before each word
        self.size = self.words.end - self.words.start + 2       # with both marks

    def each(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per gram length: the bucket at every position, and each word's number of grams."""
        b, h = self.buffer, self.buffer
        for n in range(2, max(GRAMS) + 1):
            if len(b) < n:
                return
            h = h[:len(b) - n + 1] * _BASE + b[n - 1:]
            if n in GRAMS:
                yield (mix(h + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32), np.maximum(self.size - n + 1, 0)

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """Bag of each word, and each row's bag bounds."""
        counts = self.words.counts()
        bags = -(-counts // SEGMENT)
        bounds = np.concatenate(([0], np.cumsum(bags)))
        nth = np.arange(len(self.words)) - np.repeat(self.words.bounds[:-1], counts)
        bag = np.repeat(bounds[:-1], counts) + nth // SEGMENT
        bits = np.uint64(max(1, int(bounds[-1]).bit_length()))
        key = (bag.astype(np.uint64) << (np.uint64(64) - bits)) | (self.words.hashes() >> bits)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), dtype=bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        self.size = np.where(again, 0, self.size)               # a repeated word of a bag has no grams
        return bag, bounds

    def bag_grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets in bag order, bag of each bucket, each row's bag bounds."""
        bag, bounds = self.segments()
        ids, owner = [], []
        for bucket, counts in self.each():
            at = np.repeat(self.first - np.concatenate(([0], np.cumsum(counts)))[:-1], counts) + np.arange(counts.sum())
            ids.append(bucket[at])
            owner.append(np.repeat(bag, counts))
        if not ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), bounds
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order], bounds


class Model:
    """What scoring needs of embeddings and softmax: their product, one number a bucket, the bias and the shift."""

    def __init__(self, unit: np.ndarray | None = None, bias: float = 0.0, shift: float = 0.0):
        self.unit, self.bias, self.shift = unit, bias, shift

    def bag_logits(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        size = np.diff(np.concatenate((starts, [len(ids)])))
        total = np.empty(len(starts))
        for lo in range(0, len(starts), 4096):                    # a slice of the grams at a time
            s = starts[lo:lo + 4096]
            stop = s[-1] + size[lo + len(s) - 1]
            total[lo:lo + len(s)] = np.add.reduceat(self.unit[ids[s[0]:stop]].astype(np.float64), s - s[0])
        return total / np.maximum(size, LEAST) + self.bias

    def block_scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if self.unit is None:
            return np.zeros(n)
        g = Grams(data, offsets)
        bag, bounds = g.segments()
        per_word, counts = np.zeros(len(g.words)), np.zeros(len(g.words))
        for bucket, k in g.each():
            total = np.concatenate(([0.0], np.cumsum(self.unit[bucket], dtype=np.float64)))
            some = k > 0
            per_word[some] += total[g.first[some] + k[some]] - total[g.first[some]]
            counts += k
        logit = np.full(n, self.bias)
        n_bags = int(bounds[-1])
        if n_bags:
            value = np.bincount(bag, weights=per_word, minlength=n_bags) / np.maximum(
                np.bincount(bag, weights=counts, minlength=n_bags), LEAST) + self.bias
            some = np.flatnonzero(np.diff(bounds))
            logit[some] = np.maximum.reduceat(value, bounds[some])
        return 1.0 / (1.0 + np.exp(-np.clip(logit - self.shift, -40, 40)))


class _Trainer:
    """Joint Adagrad on embeddings and softmax over mini-batches of bags.

    The model of a round is the mean of what the models of its second half say: the scores are
    linear in ``unit``, so its mean is that of all these models together."""

    def __init__(self, rng):
        self.embed = rng.normal(0, 0.02, (1 << BITS, DIM)).astype(np.float32)
        self.weights = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)
        self.seen = np.full((1 << BITS, 1), 1e-6, dtype=np.float32)
        self.seen_w, self.seen_b = np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
        self.unit, self.base, self.snapshots = np.zeros(1 << BITS), 0.0, 0

    def snapshot(self) -> None:
        self.unit += self.embed @ (self.weights[:, 1] - self.weights[:, 0])
        self.base += float(self.bias[1]) - float(self.bias[0])
        self.snapshots += 1

    def model(self) -> tuple[np.ndarray, float]:
        if not self.snapshots:
            self.snapshot()
        return (self.unit / self.snapshots).astype("<f4"), self.base / self.snapshots

    def step(self, ids: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """One mini-batch: the buckets of its bags one after the other, and their numbers."""
        cut = np.concatenate(([0], np.cumsum(size)))[:-1]
        scale = 1.0 / np.maximum(size, LEAST)[:, None]
        h = np.add.reduceat(self.embed[ids], cut, axis=0) * scale
        z = h @ self.weights + self.bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(size)), y] -= 1
        p *= (weight / len(size) * 16)[:, None]
        dh = (p @ self.weights.T) * scale
        grad_w, grad_b = h.T @ p, p.sum(axis=0)
        kinds, inverse = np.unique(ids, return_inverse=True)
        owner = np.repeat(np.arange(len(size)), size)
        grad = np.stack([np.bincount(inverse, weights=dh[owner, k], minlength=len(kinds)) for k in range(DIM)],
                        axis=1).astype(np.float32)
        self.seen[kinds] += (grad ** 2).mean(axis=1, keepdims=True)
        self.embed[kinds] -= 0.3 * grad / np.sqrt(self.seen[kinds])
        self.seen_w += grad_w ** 2
        self.weights -= 0.1 * grad_w / np.sqrt(self.seen_w)
        self.seen_b += grad_b ** 2
        self.bias -= 0.1 * grad_b / np.sqrt(self.seen_b)


def bags_of(texts: DataFrame) -> DataFrame:
    """(id, y, bag, words) of (id, y, t): the lower-cased words of every bag of the whole texts."""
    schema = texts.select("id", "y").schema.add("bag", "long").add("words", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, data, offsets in text_blocks(b.column("t")):
                words = Words(LOWER[data], offsets, ALNUM_WORDS)
                if not len(words):
                    continue
                raw, begin = words.joined()
                row, nth = words.rows(), np.arange(len(words)) - np.repeat(words.bounds[:-1], words.counts())
                first = np.flatnonzero(nth % SEGMENT == 0)
                stop = np.concatenate((begin[first[1:]], [len(raw)])) - 1      # without the last space
                at = pa.array(row[first] + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(at), b.column("y").take(at), pa.array(nth[first] // SEGMENT),
                     pa.array([raw[s:e] for s, e in zip(begin[first].tolist(), stop.tolist())], pa.binary())],
                    names=["id", "y", "bag", "words"])
    return texts.select("id", "y", "t").mapInArrow(run, schema)


def _bag_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the bags one after the other, their numbers) of a column of bags' words."""
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for _, data, offsets in text_blocks(column.cast(pa.string())):
        found, owner, bounds = Grams(data, offsets).bag_grams()
        ids.append(found)
        sizes.append(np.bincount(owner, minlength=int(bounds[-1])))
    return np.concatenate(ids), np.concatenate(sizes)


class _Target:
    """What a round trains a bag on: its document's label, or what the model before says of the bag."""

    def __init__(self, scale: float, model: Model | None = None, level: float = 0.0, best: dict | None = None):
        self.scale, self.model, self.level, self.best = scale, model, level, best

    def of(self, batch: pa.RecordBatch, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
        if self.model is None:
            return y, np.where(y == 1, self.scale, 1.0).astype(np.float32)
        toxic = y == 1
        logit = self.model.bag_logits(ids, np.cumsum(size) - size)
        best = np.array([self.best.get(i, np.inf) for i in batch.column("id").to_pylist()])
        chosen = toxic & ((logit > self.level) | (logit >= best - 1e-9))
        weight = np.where(chosen, self.scale, np.where(toxic, 0.3, 1.0)).astype(np.float32)
        return chosen.astype(np.int64), weight     # the other bags of a toxic document read as clean


def _stream(bags: DataFrame, passes: int, seed: int) -> DataFrame:
    """(id, y, words) of every bag ``passes`` times, in one partition: pass by pass in random orders."""
    rows = bags.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    order = F.xxhash64("id", "bag", "pass", F.lit(seed))
    return rows.repartition(1).sortWithinPartitions("pass", order, "id", "bag").select("id", "y", "words")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a stream in mini-batches."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, BATCH - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == BATCH:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _trained(bags: DataFrame, n: int, target: _Target, passes: int, seed: int) -> Model:
    """One round over the ``n`` bags, by one task."""
    half = passes * n // BATCH // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = _Trainer(np.random.default_rng(seed))
        for k, part in enumerate(_sliced(batches)):
            ids, size = _bag_grams(part.column("words"))
            trainer.step(ids, size, *target.of(part, ids, size))
            if k >= half and (k - half) % SNAPSHOT == 0:
                trainer.snapshot()
        unit, bias = trainer.model()
        yield pa.RecordBatch.from_arrays([pa.array([unit.tobytes()], pa.binary()), pa.array([bias])], names=["unit", "bias"])
    found = _stream(bags, passes, seed).mapInArrow(run, "unit binary, bias double").collect()[0]
    return Model(np.frombuffer(found["unit"], "<f4"), found["bias"])


def _scored(bags: DataFrame, model: Model) -> DataFrame:
    """(id, y, logit) of every bag."""
    schema = bags.select("id", "y").schema.add("logit", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, size = _bag_grams(b.column("words"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("y"), pa.array(model.bag_logits(ids, np.cumsum(size) - size))],
                names=["id", "y", "logit"])
    return bags.select("id", "y", "words").mapInArrow(run, schema)


_STEPS = 256                                       # bins of one unit of a logit


def _clean_level(scored: DataFrame, share: float) -> float:
    """The logit below which about ``share`` of the bags of clean documents lie."""
    place = F.least(F.greatest(F.floor(F.col("logit") * _STEPS), F.lit(-40 * _STEPS)), F.lit(40 * _STEPS))
    bins = sorted((r["place"], r["count"]) for r in
                  scored.where("y = 0").groupBy(place.alias("place")).count().collect())       # at most 20,481
    total, seen = sum(n for _, n in bins), 0
    for at, n in bins:
        seen += n
        if seen >= share * total:
            return (at + 1) / _STEPS
    return 0.0


def _shift(good: np.ndarray, bad: np.ndarray) -> float:
    """The logit that reads CUT: the cut between the labelled documents with the least errors,
    a missed toxic document counting MISS times."""
    grid = np.unique(np.concatenate((good[-max(1, len(good) // 10):], bad)))
    errors = (len(good) - np.searchsorted(good, grid, "left")) + MISS * np.searchsorted(bad, grid, "left")
    low = grid[np.flatnonzero(errors == errors.min())]
    below = good[np.searchsorted(good, low[-1], "left") - 1] if np.searchsorted(good, low[-1], "left") else low[0]
    return float((min(below, low[-1]) + low[-1]) / 2 - np.log(CUT / (1 - CUT)))


def fit(bags: DataFrame, seed: int = 11, bags_seen: int = BAGS_SEEN) -> Model:
    """The model of labelled bags (``bags_of``), which are read again for every pass."""
    counts = {r["y"]: r["count"] for r in bags.groupBy("y").count().collect()}
    if len(counts) < 2:
        return Model()
    n = sum(counts.values())
    passes = int(np.clip(-(-bags_seen // n), 2, MOST_PASSES))
    rng = np.random.default_rng(seed)
    target, model, best = _Target(float(np.clip(counts[0] / counts[1], 0.2, 5))), None, []
    for _ in range(ROUNDS):
        model = _trained(bags, n, target, passes, int(rng.integers(1 << 31)))
        scored = materialize(_scored(bags, model))
        level = _clean_level(scored, 0.999)
        best = scored.groupBy("id").agg(F.min("y").alias("y"), F.max("logit").alias("best")).collect()  # sampled rows
        highest = {r["id"]: r["best"] for r in best if r["y"] == 1}
        chosen = scored.where("y = 1").where(F.col("logit") > level).count()
        chosen += sum(x <= level for x in highest.values())
        target = _Target(min(20.0, (n - chosen) / max(1, chosen)), model, level, highest)
    good, bad = (np.sort([r["best"] for r in best if r["y"] == y]) for y in (0, 1))
    model.shift = _shift(good, bad)
    return model


def learn(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic",
          rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text", bags_seen: int = BAGS_SEEN) -> Model:
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min(label).cast("int").alias("y")).where(usable))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.lit(0)
    for y, n in totals.items():
        share = F.when(F.col("y") == y, F.lit(min(1_000_000, int(rows / n * 1_000_000)))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(23)), F.lit(1_000_000)) < share)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("t").alias("t"))
    return fit(materialize(bags_of(sample)), bags_seen=bags_seen)


def with_scores(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``toxic_score`` of every row."""
    check_free(keep, ["toxic_score"])
    schema = docs.select(*keep).schema.add("toxic_score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.block_scores(d, o) for _, d, o in text_blocks(b.column(text))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(scores)],
                                             names=[*keep, "toxic_score"])
    return docs.mapInArrow(run, schema)
