"""Ranked lexical search: hybrid term-at-a-time / document-at-a-time retrieval.

Pass 1 scans every whole text once and keeps, for each block of documents, the
posting lists of the words that queries use (words are matched by hash and
confirmed by their bytes), with the document lengths.  The blocks are
checkpointed; document counts, lengths and frequencies are Spark sums over
them.  Pass 2 searches each block for every item:

* lists of at most ``SHORT`` of a block's documents are added up term at a
  time into accumulators, ordered by document: one iterator, whose bound is
  the largest accumulator;
* this iterator and the long lists, each bounded by its largest contribution
  in the block, run document at a time: the iterators whose bounds together
  stay below the score of the current last place offer no candidates, they
  are only looked up (a binary search skips to the candidate) while the
  candidate's score and the bounds that are left can still reach the list.

A step takes the candidates of ``STEP`` consecutive documents as arrays.  The
limit of an item tightens over all blocks of a task; each task returns its
``top`` documents an item, and two windows merge them.

Items go in passes of at most ``ITEM_BYTES`` of text (a longer item is a pass
of its own), so neither the driver nor a task holds a whole large table of
items; the documents are read once a pass.

Cases: null and wordless texts have no words and are no document of the
statistics; wordless items return nothing; every row of ``items`` is an item
of its own, rows of one id return their ranks side by side; documents of one
id count one by one; a document without an id ranks behind equal scores;
equal scores go by ascending id.  Ids of documents are integers.  An empty
table gives an empty result.  Columns that are not named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.bytescan import ALNUM_WORDS, LOWER, Words, same_bytes, text_blocks, word_hash, word_texts
from hebdo.session import materialize

TOP = 20
ITEM_BYTES = 4 << 20
ITEM_COST = 64                  # bytes that an item costs besides its text
POSTING_BYTES = 16 << 20        # text of one block of posting lists
SHORT = 1 / 64                  # a list of at most this share of a block's documents is short
STEP = 2048                     # documents of one step
MERGE_WAYS = 64
_GAIN = 1_000_000_000


class Vocabulary:
    """Distinct query words in hash order, found in texts by hash and confirmed by bytes."""

    def __init__(self, words: list[bytes]):
        hashes = np.array([word_hash(w) for w in words], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        ranked = [words[i] for i in order.tolist()]
        self.data = np.frombuffer(b"".join(ranked), dtype=np.uint8)
        self.end = np.cumsum([len(w) for w in ranked], dtype=np.int64) if ranked else np.zeros(0, np.int64)
        self.start = self.end - np.array([len(w) for w in ranked], dtype=np.int64)

    def __len__(self) -> int:
        return len(self.number)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word position in the block, word number) of every word that is in the vocabulary."""
        hashes = words.hashes()
        lo = np.searchsorted(self.hashes, hashes, side="left")
        hi = np.searchsorted(self.hashes, hashes, side="right")
        positions, numbers = [], []
        for k in range(int((hi - lo).max(initial=0))):
            at = np.flatnonzero(lo + k < hi)
            entry = lo[at] + k
            same = same_bytes(words.data, words.start[at], words.end[at],
                              self.data, self.start[entry], self.end[entry])
            positions.append(at[same])
            numbers.append(self.number[entry[same]])
        if not positions:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(positions), np.concatenate(numbers)


_BLOCK = "ids array<bigint>, lengths array<bigint>, terms array<int>, sizes array<int>, docs binary, tf binary"


class _Postings:
    """Posting lists under construction."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.bytes, self.n = 0, 0
        self.ids, self.lengths, self.keys, self.tf = [], [], [], []

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        words = Words(LOWER[data], offsets, ALNUM_WORDS)
        at, term = self.vocabulary.find(words)
        doc = np.searchsorted(words.bounds, at, side="right") - 1 + self.n
        keys, tf = np.unique(term * (1 << 32) + doc, return_counts=True)
        self.ids.append(ids)
        self.lengths.append(words.counts())
        self.keys.append(keys)
        self.tf.append(tf)
        self.n += len(offsets) - 1
        self.bytes += len(data)

    def flush(self) -> pa.RecordBatch:
        keys, tf = np.concatenate(self.keys), np.concatenate(self.tf)
        order = np.argsort(keys, kind="stable")
        keys, tf = keys[order], tf[order]
        terms, sizes = np.unique(keys >> 32, return_counts=True)
        ends = pa.array([0, self.n], pa.int32())
        lists = pa.array([0, len(terms)], pa.int32())
        out = pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(ends, pa.concat_arrays(self.ids)),
             pa.ListArray.from_arrays(ends, pa.array(np.concatenate(self.lengths), pa.int64())),
             pa.ListArray.from_arrays(lists, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(lists, pa.array(sizes, pa.int32())),
             pa.array([(keys & 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary()),
             pa.array([tf.astype("<u4").tobytes()], pa.binary())],
            names=["ids", "lengths", "terms", "sizes", "docs", "tf"])
        self._clear()
        return out


def posting_blocks(docs: DataFrame, doc_id: str, text: str, words: list[bytes]) -> DataFrame:
    """One row a block of documents: ids, lengths in words, and the posting lists of ``words``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = _Postings(Vocabulary(words))
        for batch in batches:
            for lo, data, offsets in text_blocks(batch.column("t")):
                postings.add(batch.column("i").slice(lo, len(offsets) - 1), data, offsets)
                if postings.bytes >= POSTING_BYTES:
                    yield postings.flush()
        if postings.n:
            yield postings.flush()
    return docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).mapInArrow(run, _BLOCK)


class Best:
    """The best documents so far: highest score first, then smallest id, ids that are missing last."""

    def __init__(self, top: int):
        self.top, self.limit = top, 1
        self.score, self.id, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def offer(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        none = np.concatenate((self.none, none))
        order = np.lexsort((ids, none, -score))[:self.top]
        self.score, self.id, self.none = score[order], ids[order], none[order]
        if len(order) == self.top:
            self.limit = max(1, int(self.score[-1]))


class _Iterator:
    """Documents of a block in order, their contributions, and the largest of these."""

    __slots__ = ("docs", "gain", "bound")

    def __init__(self, docs: np.ndarray, gain: np.ndarray):
        self.docs, self.gain = docs, gain
        self.bound = int(gain.max()) if len(gain) else 0


def accumulators(lists: list[tuple[np.ndarray, np.ndarray]]) -> _Iterator:
    """Term at a time over short lists: the summed contributions, ordered by document."""
    docs, at = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    total = np.zeros(len(docs), dtype=np.int64)
    np.add.at(total, at, np.concatenate([g for _, g in lists]))
    return _Iterator(docs, total)


def _essential(iterators: list[_Iterator], limit: int) -> int:
    """Number of leading iterators (by rising bound) whose bounds together stay below the limit."""
    n, reach = 0, 0
    while n < len(iterators) and reach + iterators[n].bound < limit:
        reach += iterators[n].bound
        n += 1
    return n


def search_block(iterators: list[_Iterator], n_docs: int, best: Best, ids: np.ndarray, none: np.ndarray) -> None:
    """Document at a time over bounded iterators; offers every document that can enter ``best``."""
    iterators = sorted(iterators, key=lambda x: x.bound)
    below = np.concatenate(([0], np.cumsum([x.bound for x in iterators])))
    first = 0
    while first < n_docs:
        rest = _essential(iterators, best.limit)
        leading = iterators[rest:]
        if not leading:
            return
        # the step begins at the first document that an essential iterator still has
        spot = [int(np.searchsorted(x.docs, first)) for x in leading]
        ahead = [int(x.docs[s]) for x, s in zip(leading, spot) if s < len(x.docs)]
        if not ahead:
            return
        first = min(ahead)
        last = min(first + STEP, n_docs)
        score = np.zeros(last - first, dtype=np.int64)
        for x, s in zip(leading, spot):
            e = int(np.searchsorted(x.docs, last))
            score[x.docs[s:e] - first] += x.gain[s:e]
        found = np.flatnonzero(score + below[rest] >= best.limit)
        found = found[score[found] > 0]
        value, doc = score[found], found + first
        for k in range(rest - 1, -1, -1):               # largest bound first
            if not len(doc):
                break
            x = iterators[k]
            at = np.minimum(np.searchsorted(x.docs, doc), len(x.docs) - 1)
            value = value + np.where(x.docs[at] == doc, x.gain[at], 0)
            keep = value + below[k] >= best.limit
            value, doc = value[keep], doc[keep]
        if len(doc):
            best.offer(value, ids[doc], none[doc])
        first = last


class Weights:
    """Weight of each word and the length norm of a document, from the corpus counts."""

    def __init__(self, n_docs: int, n_words: int, df: dict[int, int], vocabulary: int):
        self.n_docs, self.n_words = n_docs, n_words
        self.weight = np.zeros(vocabulary, dtype=np.int64)
        for term, n in df.items():
            self.weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        if len(lengths) and int(lengths.max()) * 25 * self.n_docs >= 1 << 62:
            return np.array([75 + 25 * n * self.n_docs // self.n_words for n in lengths.tolist()], dtype=np.int64)
        return 75 + 25 * lengths * self.n_docs // max(1, self.n_words)


def _search(blocks: DataFrame, items: list[tuple[int, dict[int, int]]], weights: Weights, top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents for every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(top) for number, _ in items}
        for batch in batches:
            for i in range(batch.num_rows):
                column = lambda name: batch.column(name).slice(i, 1).flatten()  # noqa: E731, B023
                none = column("ids").is_null().to_numpy(zero_copy_only=False)
                ids = column("ids").fill_null(0).to_numpy(zero_copy_only=False)
                norm = weights.norm(column("lengths").to_numpy())
                terms, sizes = column("terms").to_numpy(), column("sizes").to_numpy()
                docs = np.frombuffer(batch.column("docs")[i].as_buffer(), dtype="<u4").astype(np.int64)
                tf = np.frombuffer(batch.column("tf")[i].as_buffer(), dtype="<u4").astype(np.int64)
                gain = np.repeat(weights.weight[terms], sizes) * (_GAIN * tf // (1000 * tf + 12 * norm[docs]))
                ends = np.cumsum(sizes)
                place = {t: (e - n, e) for t, n, e in zip(terms.tolist(), sizes.tolist(), ends.tolist())}
                few = max(1, int(len(ids) * SHORT))
                for number, wanted in items:
                    lists = [(docs[place[t][0]:place[t][1]], gain[place[t][0]:place[t][1]] * times)
                             for t, times in wanted.items() if t in place]
                    short = [x for x in lists if len(x[0]) <= few]
                    iterators = [_Iterator(*x) for x in lists if len(x[0]) > few]
                    if short:
                        iterators.append(accumulators(short))
                    if sum(x.bound for x in iterators) >= best[number].limit:
                        search_block(iterators, len(ids), best[number], ids, none)
        for number, b in best.items():
            if len(b.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.score), number), pa.int64()), pa.array(b.id, mask=b.none),
                     pa.array(b.score)], names=["item", "doc_id", "score"])
    return blocks.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = found.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "way").orderBy(*order)))
    near = near.where(F.col("rank") <= top).drop("rank", "way")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
        F.col("rank") <= top)


def _passes(items: DataFrame, limit: int) -> Iterator[DataFrame]:
    """The items in passes of about ``limit`` bytes of text."""
    cost = F.octet_length("t") + F.lit(ITEM_COST)
    size = items.agg(F.sum(cost.cast("long"))).first()[0] or 0
    passes = max(1, -(-size // limit))
    for k in range(passes):
        yield items if passes == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == k)


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", *, top: int = TOP,
                  item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above zero."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item).alias("i"), F.col(item_text).alias("t")).where(F.octet_length("t") > 0)
    result = None
    for part in _passes(wanted, item_bytes):
        rows = part.collect()                           # at most about ``item_bytes``
        texts = [Counter(word_texts(r["t"], ALNUM_WORDS)) for r in rows]
        words = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(words)}
        asked = [(i, {number[w]: n for w, n in t.items()}) for i, t in enumerate(texts) if t]
        blocks = materialize(posting_blocks(docs, doc_id, text, words))
        n_words = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
        n_docs = F.size(F.filter("lengths", lambda x: x > 0)).cast("long")
        totals = blocks.agg(F.sum(n_docs).alias("n"), F.sum(n_words).alias("l")).first()
        pairs = blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
        df = {r["term"]: r["df"] for r in pairs.groupBy(F.col("x.terms").alias("term")).agg(
            F.sum("x.sizes").alias("df")).collect()}    # one row a query word
        weights = Weights(totals["n"] or 0, totals["l"] or 0, df, len(words))
        names = spark.createDataFrame([(i, r["i"]) for i, r in enumerate(rows)],
                                      f"item bigint, item_id {wanted.schema['i'].dataType.simpleString()}")
        found = _ranked(_search(blocks, asked, weights, top), top).join(F.broadcast(names), "item").select(
            "item_id", "rank", "doc_id", "score")
        if result is None:
            result = found
        else:
            result = materialize(result.unionByName(found))
    return result
