"""Vector code compression: product codes whose codebooks are fitted over tries of distinct parts.

Every component x becomes the integer floor(4096 * x) and every vector is cut
into ``parts`` equal parts.  Each block of rows compiles, once, one trie per
part position: the distinct parts in lexicographic order, each with the length
of the prefix it shares with the part before it, and the place of every row's
part among them.  The tries are checkpointed; the rounds read only them.

A round walks each trie depth first (``nearest``).  A node holds the squared
distances of its prefix to all entries of the codebook, so a shared prefix is
measured once; a leaf takes the least of its vector (ties to the lower entry)
and adds its part, times the number of rows that have it, to that entry's sum.
Runs of sibling subtrees with few leaves advance level by level as arrays.
Tasks return one sum a codebook component, Spark adds them, and the driver
holds no more than the codebooks (``entries`` integers a dimension).

Integers are exact at every magnitude: where a square may leave 64 bits the
same code runs over Python integers, and sums travel as 32-bit limbs.

Cases: rows whose vector is null or holds a null, NaN or infinite component
go; rows without an id or with a repeated one are coded like any other, and
the first entries are the rows smallest by (id, nulls last; vector).  Fewer
rows than entries give fewer entries.  Empty vectors get zero codes.  Vectors
of several lengths, or of a length that ``parts`` does not divide, raise
ValueError.  An error above the largest long is that largest long.  Columns
besides the three that are named are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.vectors import finite, matrix
from hebdo.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK_ROWS = 8192               # rows of a block, which has its own tries
SUBTREE = 1024                  # leaves that advance together
SMALL_LABELS = 100_000          # label rows that are broadcast
HOT_LABEL = 1_000_000           # rows of a label that is joined by broadcast whatever the number of labels
_LONG_MAX = (1 << 63) - 1

Book = np.ndarray               # entries x components of one part position


def quantise(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as 64-bit integers, as Python integers where one does not fit."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0 ** 62:
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(x) * SCALE) for x in vectors.astype(np.float64).ravel().tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def _narrow(values: np.ndarray) -> bytes:
    """Integers in the least width that holds them, behind one letter that names it."""
    if values.dtype != object:
        low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
        for kind in ("h", "i", "q"):
            span = np.iinfo(kind)
            if span.min <= low and high <= span.max:
                return kind.encode() + values.astype(f"<{np.dtype(kind).str[1:]}").tobytes()
    return b"o" + json.dumps(values.ravel().tolist()).encode()


def _widen(raw: bytes, rows: int) -> np.ndarray:
    kind, body = raw[:1].decode(), raw[1:]
    if kind == "o":
        flat = np.array(json.loads(body), dtype=object)
    else:
        flat = np.frombuffer(body, dtype=np.dtype(kind).newbyteorder("<")).astype(np.int64)
    return flat.reshape(rows, -1 if rows else 0)


def compile_trie(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct parts in lexicographic order, place of each row's part among them)."""
    n, width = part.shape
    if not n or not width:
        return part[:min(n, 1)], np.zeros(n, np.uint16)
    if part.dtype == object:
        order = np.array(sorted(range(n), key=lambda i: part[i].tolist()))
    else:
        order = np.lexsort(part.T[::-1])
    ranked = part[order]
    new = np.concatenate(([True], (ranked[1:] != ranked[:-1]).any(axis=1)))
    place = np.empty(n, dtype=np.uint16)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def shared_prefix(leaves: np.ndarray) -> np.ndarray:
    """Number of leading components that a leaf has in common with the one before it."""
    if len(leaves) < 2 or not leaves.shape[1]:
        return np.zeros(len(leaves), np.int64)
    differ = leaves[1:] != leaves[:-1]
    return np.concatenate(([0], differ.argmax(axis=1)))


def _children(prefix: np.ndarray, lo: int, hi: int, depth: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive subtrees below a node, of at most SUBTREE leaves together, or one larger subtree."""
    starts = np.concatenate(([lo], lo + 1 + np.flatnonzero(prefix[lo + 1:hi] <= depth), [hi]))
    i = 0
    while i < len(starts) - 1:
        j = int(np.searchsorted(starts, starts[i] + SUBTREE, side="right")) - 1
        j = min(max(j, i + 1), len(starts) - 1)
        yield int(starts[i]), int(starts[j])
        i = j


def _levels(leaves, prefix, book, lo: int, hi: int, depth: int, above: np.ndarray) -> np.ndarray:
    """Distances of leaves lo..hi to all entries, level by level from a node at ``depth``."""
    node = np.zeros(hi - lo, dtype=np.int64)           # node of each leaf on the level above
    total = above[None, :]
    cut = prefix[lo:hi].copy()
    cut[0] = -1
    for j in range(depth, leaves.shape[1]):
        first = np.flatnonzero(cut <= j)               # each child node's first leaf
        step = leaves[lo + first, j][:, None] - book[None, :, j]
        total = total[node[first]] + step * step
        node = np.cumsum(cut <= j) - 1
    return total[node]


def nearest(leaves: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of every distinct part of a trie."""
    n, width = leaves.shape
    kind = object if leaves.dtype == object or book.dtype == object else np.int64
    best, least = np.zeros(n, np.int64), np.zeros(n, kind)
    if not n:
        return best, least
    prefix = shared_prefix(leaves)
    stack = [(0, n, 0, np.zeros(len(book), kind))]
    while stack:
        lo, hi, depth, above = stack.pop()
        if hi - lo > SUBTREE and depth < width:
            for a, b in _children(prefix, lo, hi, depth):
                if b - a > SUBTREE:                    # one subtree: its shared component is measured here
                    step = leaves[a, depth] - book[:, depth]
                    stack.append((a, b, depth + 1, above + step * step))
                else:
                    stack.append((a, b, depth, above))
            continue
        total = _levels(leaves, prefix, book, lo, hi, depth, above)
        best[lo:hi] = total.argmin(axis=1)
        least[lo:hi] = total[np.arange(hi - lo), best[lo:hi]]
    return best, least


def _exact(books: list[Book], leaves: np.ndarray) -> np.ndarray:
    """The leaves, over Python integers where a sum of squares or of a block's parts may leave 64 bits."""
    if leaves.dtype == object or any(b.dtype == object for b in books):
        return leaves.astype(object)
    top = max([int(abs(x)) for a in (leaves, *books) if a.size for x in (a.min(), a.max())], default=0)
    if 4 * top * top * max(1, leaves.shape[1]) >= 1 << 62 or top * BLOCK_ROWS * 8 >= 1 << 62:
        return leaves.astype(object)
    return leaves


def _read_block(row: dict, books: list[Book]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for p, trie in enumerate(row["tries"]):
        place = np.frombuffer(trie["place"], dtype="<u2").astype(np.int64)
        rows = int(place.max()) + 1 if len(place) else 0
        yield p, _exact([books[p]], _widen(trie["leaves"], rows)), place


def _blocks(rows: DataFrame, names: tuple[str, str, str], parts: int) -> DataFrame:
    """One row a block: ids, labels and a trie for each part position."""
    vec_id, vector, label = names
    schema = (f"ids array<{rows.schema[vec_id].dataType.simpleString()}>, "
              f"labels array<{rows.schema[label].dataType.simpleString()}>, "
              "tries array<struct<leaves:binary,place:binary>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(lo, BLOCK_ROWS)
                values = quantise(matrix(block.column(vector)))
                width = values.shape[1] // parts
                tries = []
                for p in range(parts):
                    leaves, place = compile_trie(values[:, p * width:(p + 1) * width])
                    tries.append({"leaves": _narrow(leaves), "place": place.astype("<u2").tobytes()})
                ends = pa.array([0, block.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, block.column(vec_id)),
                     pa.ListArray.from_arrays(ends, block.column(label)),
                     pa.array([tries], pa.list_(pa.struct([("leaves", pa.binary()), ("place", pa.binary())])))],
                    names=["ids", "labels", "tries"])
    return rows.mapInArrow(run, schema)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """32-bit limbs of an integer, the highest one signed: sums of limbs give the sum."""
    n = 0
    while not -(1 << 31) <= value < 1 << 31:
        yield n, value & 0xFFFFFFFF
        value >>= 32
        n += 1
    yield n, value


def _part_sums(tries: DataFrame, books: list[Book]) -> dict[tuple[int, int, int], int]:
    """{(part, entry, component): sum}; component -1 counts the parts of an entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for p, leaves, place in _read_block(row, books):
                    weight = np.bincount(place, minlength=len(leaves))
                    entry, _ = nearest(leaves, books[p])
                    order = np.argsort(entry, kind="stable")
                    at = np.flatnonzero(np.diff(entry[order], prepend=-1))
                    if not len(at):
                        continue
                    sums = np.add.reduceat((leaves * weight[:, None])[order], at, axis=0)
                    counts = np.add.reduceat(weight[order], at)
                    for e, s, n in zip(entry[order][at].tolist(), sums.tolist(), counts.tolist()):
                        for d, x in zip((-1, *range(len(s))), (n, *s)):
                            total[p, e, d] = total.get((p, e, d), 0) + x
        flat = [(*key, k, x) for key, value in total.items() for k, x in _limbs(value)]
        columns = [pa.array(c, pa.int64()) for c in zip(*flat)] or [pa.array([], pa.int64())] * 5
        yield pa.RecordBatch.from_arrays(columns, names=["p", "e", "d", "limb", "x"])

    limbs = tries.select("tries").mapInArrow(run, "p bigint, e bigint, d bigint, limb bigint, x bigint").groupBy(
        "p", "e", "d", "limb").agg(F.sum("x").alias("x"))
    out: dict[tuple[int, int, int], int] = {}
    for r in limbs.collect():                          # codebook components: entries a dimension
        key = (r["p"], r["e"], r["d"])
        out[key] = out.get(key, 0) + (r["x"] << (32 * r["limb"]))
    return out


def _integers(values: list[list[int]], width: int) -> np.ndarray:
    fits = all(-(1 << 62) < x < 1 << 62 for row in values for x in row)
    return np.array(values, dtype=np.int64 if fits else object).reshape(len(values), width)


def _refined(books: list[Book], sums: dict[tuple[int, int, int], int]) -> list[Book]:
    out = []
    for p, book in enumerate(books):
        rows = book.tolist()
        for e in range(len(rows)):
            n = sums.get((p, e, -1), 0)
            if n:
                rows[e] = [sums[p, e, d] // n for d in range(book.shape[1])]
        out.append(_integers(rows, book.shape[1]))
    return out


def codebook_digest(books: list[Book]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for row in b.tolist() for x in row).encode()).hexdigest()


def fit(tries: DataFrame, books: list[Book], rounds: int = ROUNDS) -> list[Book]:
    """The codebooks after ``rounds`` rounds; a round that changes nothing is the last that runs."""
    for _ in range(rounds):
        new = _refined(books, _part_sums(tries, books))
        if all((a == b).all() for a, b in zip(new, books)):
            break
        books = new
    return books


_HEX = np.array([list(f"{i:02x}".encode()) for i in range(256)], dtype=np.uint8)


def _coded(tries: DataFrame, books: list[Book]) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    parts = len(books)
    schema = ", ".join(f"{n} {tries.schema[c].dataType.elementType.simpleString()}"
                       for n, c in (("vec_id", "ids"), ("label", "labels"))) + ", code string, error bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["tries"]).to_pylist()):
                ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
                codes, error = np.zeros((len(ids), parts), np.uint8), None
                for p, leaves, place in _read_block(row, books):
                    entry, least = nearest(leaves, books[p])
                    codes[:, p] = entry[place]
                    error = least[place].astype(object) if error is None else error + least[place]
                text = _HEX[codes].reshape(len(ids), 2 * parts)
                code = pa.array([t.tobytes().decode() for t in text], pa.string())
                long = pa.array([min(int(x), _LONG_MAX) for x in error.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, labels, code, long], names=["vec_id", "label", "code", "error"])
    return tries.mapInArrow(run, schema)


def _with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` and the error of all rows of the same label (nulls together)."""
    total = F.least(F.sum(F.col("error").cast("decimal(19,0)")), F.lit(_LONG_MAX)).cast("long")
    sums = materialize(rows.groupBy(F.col("label").alias("of")).agg(
        total.alias("label_error"), F.count("*").alias("n")))
    if sums.count() <= SMALL_LABELS:
        return rows.join(F.broadcast(sums.drop("n")), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    # many labels: those of very many rows are few and broadcast, the rest meet their rows by a shuffle
    hot = sums.where(F.col("n") > HOT_LABEL).select("of", "label_error")
    marked = rows.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    cold = sums.where(F.col("n") <= HOT_LABEL).select("of", "label_error")
    left = marked.where("label_error is null").drop("label_error")
    return marked.where("label_error is not null").unionByName(
        left.join(cold, F.col("label").eqNullSafe(F.col("of"))).drop("of"))


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *,
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row with a finite vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows = vectors.select(F.col(vec_id).alias("i"), F.col(vector).alias("v"), F.col(label).alias("l")).where(
        finite("v"))
    sizes = rows.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if sizes["lo"] is not None and (sizes["lo"] != sizes["hi"] or sizes["lo"] % parts):
        raise ValueError(f"vectors of {sizes['lo']} to {sizes['hi']} components cannot be cut into {parts} equal parts")
    first = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = (sizes["lo"] or 0) // parts
    start = quantise(np.array([r["v"] for r in first], dtype=np.float64).reshape(len(first), width * parts)).tolist()
    books = [_integers([r[p * width:(p + 1) * width] for r in start], width) for p in range(parts)]
    tries = materialize(_blocks(rows, ("i", "v", "l"), parts))
    if first and width:
        books = fit(tries, books, rounds)
    coded = _with_label_errors(materialize(_coded(tries, books)))
    return coded.withColumn("codebooks_sha256", F.lit(codebook_digest(books)))
