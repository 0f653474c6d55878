"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are lower-cased words, the patterns are all windows of ``window``
consecutive words of every benchmark item (an item with fewer words is one
shorter pattern).  Per pattern length: a shift table over two-word blocks
says how far a search position may skip, a zero shift leads to the bucket of
patterns that end with that block, and a direct comparison (all word hashes,
then the bytes) confirms an occurrence.  Many positions advance at once:
every row is cut into segments of ``SEGMENT`` end positions, each with its
own cursor, so the skips run as vector operations.

The items travel with the tasks, which build the pattern tables once a worker.
Their size is bounded by ``BLOCK_ITEM_BYTES`` of benchmark text: a larger
benchmark is searched in that many passes, one after the other, and the driver
holds the items of one pass at a time.  For that, the documents are written
once with a row number; a pass reads them and writes the hits of the few rows
that have any, and the hits of all passes are merged by row number.  An item
above ``PIECE_WORDS`` words is cut into pieces that overlap by a window less
a word, so no window is lost and no item makes a pass larger.

Cases: a null or wordless text has zero words and no hits; a wordless item
never occurs; equal windows of several items count for each of them; items
without an id are searched and covered like any other and count as one item, which
the id list gives as null, last; repeated rows are judged one by one; rows of other columns pass through unchanged; an
empty benchmark or an empty table gives no hits.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.bytescan import ALNUM_WORDS, LOWER, Words, mix, text_blocks, word_hash, word_texts
from hebdo.llm.names import check_free, free_name
from hebdo.session import materialize

WINDOW = 10
SEGMENT = 64
PIECE_WORDS = 32_768
TABLE_BITS = 16
BLOCK_ITEM_BYTES = 2 << 20
ITEM_COST = 64                  # bytes that an item costs besides its text
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _block_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the block of ``width`` words ending at each position (the first positions are unused)."""
    if width == 1:
        return mix(words)
    out = words.copy()
    out[1:] = mix(words[:-1] * _PAIR + words[1:])
    return out


class PatternGroup:
    """Patterns of one length: shift table, suffix buckets, word sequences."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.width = length, min(2, length)
        hashes: dict[bytes, np.uint64] = {}
        for words in patterns:
            for w in words:
                if w not in hashes:
                    hashes[w] = word_hash(w)
        rows = np.array([[hashes[w] for w in words] for words in patterns], dtype=np.uint64)
        self.texts, self.items = [b" ".join(p) for p in patterns], list(patterns.values())
        blocks = np.stack([_block_hash(r, self.width) for r in rows])
        self.shift = np.full(1 << TABLE_BITS, length - self.width + 1, dtype=np.int64)
        for end in range(self.width - 1, length):
            np.minimum.at(self.shift, self._slot(blocks[:, end]), length - 1 - end)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.suffix, self.rows, self.order = blocks[order, -1], rows[order], order

    @staticmethod
    def _slot(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end word position, pattern number) of every occurrence."""
        ends, found = [], []
        counts = np.diff(bounds)
        enough = np.flatnonzero(counts >= self.length)
        if not len(enough):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spans = counts[enough] - self.length + 1                # end positions of each row
        segments = -(-spans // SEGMENT)
        first = np.concatenate(([0], np.cumsum(segments)))[:-1]
        nth = np.arange(segments.sum()) - np.repeat(first, segments)
        cursor = np.repeat(bounds[enough] + self.length - 1, segments) + nth * SEGMENT
        limit = np.minimum(cursor + SEGMENT, np.repeat(bounds[enough + 1], segments))
        block = _block_hash(words, self.width)
        skip = self.shift[self._slot(block)]
        while len(cursor):
            step = skip[cursor]
            hit = cursor[step == 0]
            if len(hit):
                lo = np.searchsorted(self.suffix, block[hit], side="left")
                hi = np.searchsorted(self.suffix, block[hit], side="right")
                for k in range(int((hi - lo).max(initial=0))):
                    at = np.flatnonzero(lo + k < hi)
                    entry = lo[at] + k
                    index = hit[at][:, None] + np.arange(1 - self.length, 1)
                    same = (words[index] == self.rows[entry]).all(axis=1)
                    ends.append(hit[at][same])
                    found.append(self.order[entry[same]])
            cursor = cursor + np.maximum(step, 1)
            left = cursor < limit
            cursor, limit = cursor[left], limit[left]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(found)


def compile_patterns(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[PatternGroup]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        words = word_texts(text, ALNUM_WORDS)
        if words:
            size = min(window, len(words))
            for i in range(len(words) - size + 1):
                by_length[size][tuple(words[i:i + size])].append(item_id)
    return [PatternGroup(size, dict(patterns)) for size, patterns in sorted(by_length.items())]


def _scan(groups: list[PatternGroup], data: np.ndarray, offsets: np.ndarray):
    """Per row of a block: number of words, covered [first, end) word spans, item ids."""
    data = LOWER[data]
    words = Words(data, offsets, ALNUM_WORDS)
    hashes = words.hashes()
    n = len(offsets) - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[set[str]] = [set() for _ in range(n)]
    for g in groups:
        ends, found = g.find(hashes, words.bounds)
        if not len(ends):
            continue
        rows = np.searchsorted(words.bounds, ends, side="right") - 1
        for end, pattern, row in zip(ends.tolist(), found.tolist(), rows.tolist()):
            first = end - g.length + 1
            text = b" ".join(data[s:e].tobytes() for s, e in zip(words.start[first:end + 1].tolist(),
                                                                words.end[first:end + 1].tolist()))
            if text == g.texts[pattern]:
                base = int(words.bounds[row])
                spans[row].append((first - base, end + 1 - base))
                items[row].update(g.items[pattern])
    return words.counts(), spans, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _ordered(items) -> list[str | None]:
    return sorted(items, key=lambda i: (i is None, i or ""))


def _pack(n_words: int, spans, items) -> bytes:
    flat = [x for s in spans for x in s]
    ids = json.dumps(_ordered(items)).encode() if items else b""
    return struct.pack(f"<qq{len(flat)}q", n_words, len(spans), *flat) + ids


def _unpack(state: bytes):
    n_words, k = struct.unpack_from("<qq", state)
    flat = struct.unpack_from(f"<{2 * k}q", state, 16)
    rest = state[16 + 16 * k:].decode()
    return n_words, list(zip(flat[::2], flat[1::2])), set(json.loads(rest)) if rest else set()


Items = list[tuple[str | None, str | None]]
_TABLES: dict[bytes, list[PatternGroup]] = {}


def _tables(items: Items, window: int) -> list[PatternGroup]:
    """The pattern tables of a pass, built once a worker; the tables of the pass before are let go."""
    key = hashlib.sha256(json.dumps([window, items]).encode()).digest()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = compile_patterns(items, window)
    return _TABLES[key]


def _with_state(docs: DataFrame, items: Items, window: int, text: str, state: str, keep: list[str],
                earlier: str | None = None) -> DataFrame:
    """``keep`` and a binary column with the word count and the hits of each row.

    ``earlier`` names a column with lists of hits that were found before; they are added."""
    out_schema = docs.select(*keep).schema.add(state, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _tables(items, window)
        for batch in batches:
            before = batch.column(earlier).to_pylist() if earlier else None
            new: list[bytes] = []
            for lo, data, offsets in text_blocks(batch.column(text)):
                counts, spans, found = _scan(groups, data, offsets)
                for i, n in enumerate(counts.tolist()):
                    for hits in (before[lo + i] or []) if before else []:
                        _, s, t = _unpack(hits)
                        spans[i] += s
                        found[i] |= t
                    new.append(_pack(n, _merge(spans[i]), found[i]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(new, pa.binary())],
                                             names=[*keep, state])
    return docs.mapInArrow(run, out_schema)


_NO_HITS = "substring(`{0}`, 9, 8) = X'0000000000000000'"  # the state: word count, number of spans, eight bytes each


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(i, t) of all items with words; long items in overlapping pieces."""
    step = max(1, PIECE_WORDS - window + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for i, t in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist()):
                words = word_texts(t, ALNUM_WORDS)
                if len(words) <= PIECE_WORDS:
                    cuts = [words] if words else []
                else:
                    cuts = [words[k:k + step + window - 1] for k in range(0, len(words) - window + 1, step)]
                ids += [i] * len(cuts)
                texts += [b" ".join(c).decode() for c in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["i", "t"])
    return benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).mapInArrow(
        run, "i string, t string")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, state: str = "benchmark_state",
                   keep: list[str] | None = None, item_block_bytes: int = BLOCK_ITEM_BYTES) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and a binary state column
    that holds each row's hits (see ``hit_digest``)."""
    check_free(docs.columns, [state])
    keep = docs.columns if keep is None else keep
    items = materialize(_pieces(benchmark, item, item_text, window))
    size = items.agg(F.sum(F.octet_length("t") + F.lit(ITEM_COST))).first()[0] or 0
    passes = max(1, -(-size // item_block_bytes))
    collect = lambda rows: [(r["i"], r["t"]) for r in rows.collect()]  # noqa: E731  a pass at most
    if passes == 1:
        return _with_state(docs, collect(items), window, text, state, keep)
    row, hits = free_name(docs, "row_number"), free_name(docs, "pass_hits")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()))     # written: the numbers are fixed
    found = None
    for k in range(passes):
        part = collect(items.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == k))
        new = _with_state(numbered.select(row, text), part, window, text, state, [row])
        new = new.where(f"NOT {_NO_HITS.format(state)}")
        found = materialize(new if found is None else found.unionByName(new))
    merged = found.groupBy(F.col(row).alias("__row")).agg(F.collect_list(state).alias(hits))     # a list entry a pass
    rows = numbered.join(merged, F.col(row) == F.col("__row"), "left").drop("__row", row)
    return _with_state(rows, [], window, text, state, keep, earlier=hits)


DIGEST = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, hit_spans " \
         "array<struct<first:bigint,end:bigint>>, items array<string>"


def hit_digest(hits: DataFrame, keep: list[str], state: str = "benchmark_state") -> DataFrame:
    """The columns ``keep`` plus word counts, item digests, covered word spans and item ids."""
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "items"]
    check_free(keep, names)
    head = hits.select(*keep, state)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema.fields if f.name != state)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_unpack(s) for s in batch.column(state).to_pylist()]
            hit = [sum(b - a for a, b in s) for _, s, _ in out]
            ids = [_ordered(t) for _, _, t in out]
            columns = [batch.column(i) for i in range(width)] + [
                pa.array([n for n, _, _ in out], pa.int64()), pa.array(hit, pa.int64()),
                pa.array([len(t) for t in ids], pa.int64()),
                pa.array([hashlib.sha256(",".join(i for i in t if i is not None).encode()).hexdigest()
                          for t in ids], pa.string()),
                pa.array([h > 0 for h in hit], pa.bool_()),
                pa.array([[{"first": a, "end": b} for a, b in s] for _, s, _ in out],
                         pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])
    return head.mapInArrow(run, f"{schema}, {DIGEST}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; same columns."""
    state = free_name(docs, "benchmark_state")
    hits = benchmark_hits(docs, benchmark, state=state, **options)
    return hits.where(_NO_HITS.format(state)).drop(state)
