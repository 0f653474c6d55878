"""Quality classifier: Bradley-Terry pairwise ranking of documents.

A document's strength is linear in surface measurements of its whole text
(repetition, case, symbols, line and word shapes).  Pairs of one document
labelled good and one labelled bad are preferences; the weights minimise the
logistic loss of the difference of the two feature rows, so only differences
between documents matter and no absolute target is fitted.  A score quantile
of the labelled sample (its share of bad rows) then gives the rejection
threshold, and the score is a logistic of the distance to it, placed so that
the threshold reads ``CUT``.

Fitting uses at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of
the id (documented bound); their feature rows (a few dozen numbers each) come
to the driver, texts never do.  Scoring covers every row and its whole text.

Cases: a null or empty text has all-zero measurements and gets the score of
that row; labels that are null are ignored; repeated label rows of an id use
the smallest label, repeated document rows its smallest text; with one class only, or no labels, every score is 1.0;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.bytescan import LOWER, SPACE_WORDS, Words, mix, text_blocks
from hebdo.llm.names import check_free, free_name

SAMPLE_ROWS = 20_000
N_PAIRS = 20_000
CUT = 0.3
STEPS = 200

_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>{}[]\\^~_=+@"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
_CLASSES = {"upper": _UPPER, "digit": _DIGIT, "symbol": _SYMBOL, "stop": _STOP,
            "bang": np.arange(256) == ord("!"), "comma": np.arange(256) == ord(","),
            "newline": np.arange(256) == 10, "blank": np.arange(256) == 0x20}

FEATURES = [*_CLASSES, "log_words", "word_len", "long_words", "repeated", "adjacent", "repeat3", "top_word",
            "upper_words", "upper_sq", "symbol_sq", "adjacent_sq", "repeat3_sq"]


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct_share(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of distinct keys, and the count of its most frequent key."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(keys):
        row_bits = max(1, int(n).bit_length())
        k = np.sort((rows.astype(np.uint64) << np.uint64(64 - row_bits)) | (keys >> np.uint64(row_bits)))
        at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        size = np.diff(np.concatenate((at, [len(k)])))
        r = (k[at] >> np.uint64(64 - row_bits)).astype(np.int64)
        distinct = np.bincount(r, minlength=n).astype(float)
        np.maximum.at(top, r, size)
    return distinct, top


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One measurement row per text of a block (columns: ``FEATURES``)."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(offsets)
    per_byte = 1.0 / np.maximum(size, 1)
    for i, table in enumerate(_CLASSES.values()):
        out[:, i] = _row_sums(table[data], offsets) * per_byte
    w = Words(LOWER[data], offsets, SPACE_WORDS)
    counts = w.counts()
    per_word, smooth = 1.0 / np.maximum(counts, 1), 1.0 / (counts + 8.0)     # few words prove little
    rows, h, length = w.rows(), w.hashes(), w.end - w.start
    distinct, top = _distinct_share(h, rows, n)
    adjacent = np.zeros(len(h), dtype=bool)
    adjacent[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    gram, inside = h[:0], np.zeros(0, dtype=bool)
    if len(h) > 2:
        gram = mix(mix(h[:-2]) + h[1:-1]) * np.uint64(0x9E3779B97F4A7C15) + h[2:]
        inside = rows[:-2] == rows[2:]
    grams = np.bincount(rows[:-2][inside], minlength=n) if len(h) > 2 else np.zeros(n)
    gram_kinds, _ = _distinct_share(gram[inside], rows[:-2][inside] if len(h) > 2 else rows[:0], n)
    k = len(_CLASSES)
    out[:, k] = np.log1p(counts)
    out[:, k + 1] = _row_sums(length, w.bounds) * per_word
    out[:, k + 2] = _row_sums(length > 24, w.bounds) * per_word
    out[:, k + 3] = (counts - distinct) * smooth
    out[:, k + 4] = _row_sums(adjacent, w.bounds) * smooth
    out[:, k + 5] = (grams - gram_kinds) * smooth
    out[:, k + 6] = top * smooth
    out[:, k + 7] = _row_sums(_UPPER[data[w.start]], w.bounds) * per_word
    for j, source in enumerate((0, 2, k + 4, k + 5)):
        out[:, k + 8 + j] = np.sqrt(out[:, source])
    return out


class Ranker:
    """Bradley-Terry strengths: standardised features times weights, minus the quantile threshold."""

    def __init__(self, mean=None, scale=None, weights=None, threshold=0.0):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, pairs: int = N_PAIRS, seed: int = 7) -> Ranker:
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            return cls()
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.clip((x - mean) / scale, -8, 8)
        rng = np.random.default_rng(seed)
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        w = np.zeros(d.shape[1])
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, STEPS + 1):                # Adam on the mean logistic loss with a small ridge
            p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -30, 30)))
            g = -(d * p[:, None]).mean(axis=0) + 1e-3 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        s = np.sort(z @ w)
        cut = len(bad)                               # the quantile at the share of bad rows
        lo, hi = s[max(cut - 1, 0)], s[min(cut, len(s) - 1)]
        return cls(mean, scale, w, float((lo + hi) / 2))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        s = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.threshold
        return 1.0 / (1.0 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -40, 40)))


def text_scores(model: Ranker, column: pa.Array) -> np.ndarray:
    parts = [model.score(features(d, o)) for _, d, o in text_blocks(column)]
    return np.concatenate(parts) if parts else np.zeros(0)


def label_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, y, t) of about ``rows`` labelled documents chosen by id hash; ``usable`` filters ids.

    An id has one row, with its smallest label and text."""
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min(label).cast("int").alias("y")).where(usable))
    total = known.count()
    if total > rows:
        share = F.lit(int(rows / total * 1_000_000))
        known = known.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1_000_000)) < share)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(known), "id")
    return texts.groupBy("id").agg(F.min("y").alias("y"), F.min("t").alias("t"))


def learn(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          rows: int = SAMPLE_ROWS) -> Ranker:
    sample = label_sample(docs, labels, label, usable, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(d, o) for _, d, o in text_blocks(b.column("t"))]
            if x:
                flat = np.concatenate(x).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("y"), pa.array([r.tobytes() for r in flat], pa.binary())],
                    names=["id", "y", "x"])

    got = sample.mapInArrow(run, "id bigint, y int, x binary").orderBy("id").toPandas()
    if not len(got):
        return Ranker()
    x = np.stack([np.frombuffer(v) for v in got["x"]])
    return Ranker.fit(x, got["y"].to_numpy())


def with_scores(docs: DataFrame, model: Ranker, keep: list[str], text: str = "text",
                score: str = "quality_score") -> DataFrame:
    """The columns ``keep`` and the score of every row."""
    check_free(keep, [score])
    schema = docs.select(*keep).schema.add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array(text_scores(model, b.column(text)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [scores], names=[*keep, score])
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Ranker, text: str = "text") -> DataFrame:
    """``docs`` without the rows scored below ``CUT``; same columns."""
    score = free_name(docs, "quality_score")
    return with_scores(docs, model, docs.columns, text, score).where(F.col(score) >= CUT).drop(score)
