"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: lower-cased words, shingles of ``shingle`` words (repeats count)
joined by single spaces, XXH64 with seed 42 of each; a bit is one if it is
set in over half of the hashes.

Comparison: equal fingerprints are one class first (its smallest id stands
for it).  A tile holds the classes whose four 16-bit quarters have the same
population counts.  The bit distance is at least the sum of the differences
of those counts, so a pair of tiles whose counts differ by more than the
radius in sum is skipped; all other pairs are compared by exclusive-or and
bit counts, in numpy, block against block.  A class is sent to its own tile
as a resident and to the tiles in reach (in one direction, so a pair of tiles
meets once) as a probe.  Tiles of more than ``TILE`` residents are cut by
hash, and the probes visit every cut, so no task holds more than about a tile
and a block of probes.  A task returns a spanning forest of the links it
finds, never all pairs; connectivity is kept whole.

Cases: a null, empty or wordless text has fingerprint zero, linked like any
other; a text with fewer words than a shingle has its whole word sequence as
its one shingle; repeated rows of an id are one node; a null id gets a null
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.bytescan import LOWER, SPACE_WORDS, Words, text_blocks
from hebdo.llm.components import components
from hebdo.llm.names import free_name
from hebdo.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 4096
PROBES = 512


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text of a block."""
    n = len(offsets) - 1
    words = Words(LOWER[data], offsets, SPACE_WORDS)
    raw, begin = words.joined()
    counts = words.counts()
    stop = begin + (words.end - words.start)
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(shingles)))
    first = np.repeat(words.bounds[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    last = np.minimum(first + shingle, np.repeat(words.bounds[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(begin[first].tolist(), stop[last].tolist())),
                    dtype="<u8", count=int(bounds[-1]))
    out = np.zeros(n, dtype=np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int32)
        major = (ones * 2 > shingles[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").reshape(-1, 8).view("<u8")[:, 0]
    return out


def with_fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint's bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [fingerprints(d, o, shingle) for _, d, o in text_blocks(b.column("t"))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(
        run, "id bigint, fp bigint")


def _reach(radius: int) -> list[int]:
    """Tile number offsets within the radius, those not below the tile itself."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius]
    return [s for s in steps if s >= (0, 0, 0, 0)]


def _quarter(q: int):
    return F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest connected node of each of ``n`` nodes, given edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            break
        label = new
    return label


class _Cut:
    """One cut of a tile: its residents, and the links found so far as a forest."""

    def __init__(self, radius: int):
        self.radius, self.fp, self.id, self.parts = radius, np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def residents(self, fp: np.ndarray, ids: np.ndarray) -> None:
        self.fp, self.id = np.concatenate((self.fp, fp)), np.concatenate((self.id, ids))

    def probe(self, fp: np.ndarray, ids: np.ndarray) -> None:
        for lo in range(0, len(fp), PROBES):
            p, q = fp[lo:lo + PROBES], ids[lo:lo + PROBES]
            near = np.bitwise_count(self.fp[None, :] ^ p[:, None]) <= self.radius
            i, j = np.nonzero(near)
            other = q[i] != self.id[j]
            if other.any():
                self.parts.append(_spanning(q[i[other]], self.id[j[other]]))
                if sum(len(x[0]) for x in self.parts) > 8 * TILE:
                    self.parts = [_spanning(*map(np.concatenate, zip(*self.parts)))]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _spanning(*map(np.concatenate, zip(*self.parts)))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest connected node) pairs that connect what the given links connect."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    label = forest(index[:len(a)], index[len(a):], len(nodes))
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links (a, b) between class ids whose fingerprints differ in 1..radius bits.

    ``classes``: (fp, id), fingerprints distinct."""
    base = classes.select("fp", "id", *[_quarter(q).cast("int").alias(f"q{q}") for q in range(4)])
    number = "q0 * 4913 + q1 * 289 + q2 * 17 + q3"
    base = base.withColumn("tile", F.expr(number))
    # at most 17 ** 4 = 83,521 tiles, of which only those to be cut come to the driver
    large = {r["tile"]: -(-r["count"] // tile) for r in
             base.groupBy("tile").count().where(F.col("count") > tile).collect()}
    cuts = F.lit(1)
    if large:
        sizes = classes.sparkSession.createDataFrame(sorted(large.items()), "cell int, cuts int")
    steps = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(s)]) for s in _reach(radius)])
    probes = base.withColumn("s", F.explode(steps)).where(" and ".join(
        f"q{i} + s.d{i} between 0 and 16" for i in range(4))).select(
        F.expr("(q0 + s.d0) * 4913 + (q1 + s.d1) * 289 + (q2 + s.d2) * 17 + q3 + s.d3").alias("cell"),
        F.lit(1).alias("probe"), "fp", "id")
    residents = base.select(F.col("tile").alias("cell"), F.lit(0).alias("probe"), "fp", "id")
    rows = residents.unionByName(probes)
    if large:
        rows = rows.join(F.broadcast(sizes), "cell", "left")
        cuts = F.coalesce("cuts", F.lit(1))
        home = F.pmod(F.xxhash64("fp"), cuts).cast("int")
        rows = rows.withColumn("cut", F.explode(
            F.when(F.col("probe") == 0, F.array(home)).otherwise(F.sequence(F.lit(0), cuts - 1))))
    else:
        rows = rows.withColumn("cut", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cut = None, None

        def done():
            a, b = cut.links()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = (batch.column("cell").to_numpy(zero_copy_only=False).astype(np.int64) << 32) \
                | batch.column("cut").to_numpy(zero_copy_only=False)
            role = batch.column("probe").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(keys) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(keys)]):
                if keys[lo] != key:
                    if cut is not None and cut.parts:
                        yield done()
                    key, cut = keys[lo], _Cut(radius)
                if role[lo] == 0:
                    cut.residents(fp[lo:hi], ids[lo:hi])
                elif len(cut.fp):
                    cut.probe(fp[lo:hi], ids[lo:hi])
        if cut is not None and cut.parts:
            yield done()

    ordered = rows.select("cell", "cut", "probe", "fp", "id").repartition("cell", "cut").sortWithinPartitions(
        "cell", "cut", "probe")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id reachable over links."""
    signed = materialize(with_fingerprints(docs, doc_id, text, shingle))
    classes = materialize(signed.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")))
    # an id whose rows have several fingerprints is one node: it links their classes
    several = signed.groupBy("id").agg(F.min("fp").alias("f0"), F.max("fp").alias("f1")).where("f0 <> f1").select(
        F.col("id").alias("b"))
    shared = several.join(signed, several["b"] == signed["id"]).select("b", "fp").distinct()
    shared = shared.join(classes.select("fp", F.col("id").alias("a")), "fp").select("a", "b")
    linked = components(links(classes, radius).unionByName(shared), "a", "b")
    classes = classes.join(linked, classes["id"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component"))
    same = signed.join(classes, "fp", "left")
    return same.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the row whose id is the group's smallest.

    Where an id has several rows, the least of them (by text, then the other columns) stays; rows
    without an id go."""
    found = materialize(near_duplicates(docs, doc_id, text, shingle, radius))
    keeper, row = free_name(docs, "keeper"), free_name(docs, "least_row")
    keepers = found.where("id = component").groupBy(F.col("id").alias(keeper)).agg(F.count("*").alias("n"))
    kept = docs.join(keepers.select(keeper), F.col(doc_id).cast("long") == F.col(keeper), "left_semi")
    if not keepers.where("n > 1").head(1):
        return kept
    least = kept.groupBy(doc_id).agg(F.min_by(F.struct(*docs.columns), _merit(docs, text, doc_id)).alias(row))
    return least.select(*[F.col(c) if c == doc_id else F.col(row)[c].alias(c) for c in docs.columns])


def _merit(docs: DataFrame, text: str, doc_id: str):
    """What rows of one id are told apart by: the text, then the other columns, then the id."""
    rest = [c for c in docs.columns if c not in (doc_id, text)]
    # a column that has no order (one that holds a map) counts by its JSON
    def comparable(c):
        held = docs.schema[c].dataType.simpleString()
        return F.to_json(F.struct(c)) if "map<" in held or "variant" in held else F.col(c)
    return F.struct(text, *[comparable(c).alias(f"c{i}") for i, c in enumerate(rest)], doc_id)


def _tagged(docs: DataFrame, text: str, name: str, shingle: int) -> DataFrame:
    """``docs`` and the fingerprint of every row, as column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [fingerprints(d, o, shingle) for _, d, o in text_blocks(b.column(text))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))],
                                             names=[*b.schema.names, name])
    return docs.mapInArrow(run, docs.select("*", F.lit(0).cast("long").alias(name)).schema)


def keep_one_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts: the one with the smallest id.

    Groups are components of fingerprints alone, so rows without an id and different texts of one id
    stay unless they are near-duplicates.  Null ids come last; rows of one id in one group are told
    apart by text, then the other columns."""
    signed = materialize(with_fingerprints(docs, doc_id, text, shingle))
    classes = signed.select("fp", F.col("fp").alias("id")).distinct()
    linked = components(links(materialize(classes), radius), "a", "b")
    found = signed.join(linked, signed["fp"] == linked["node"], "left").select(
        "id", "fp", F.coalesce("component", "fp").alias("component"))
    keepers = materialize(found.groupBy("component").agg(F.min("id").alias("keeper")))
    repeated = materialize(signed.where("id is not null").groupBy("id").count().where("count > 1").select("id"))

    key, fp, row = free_name(docs, "keeper"), free_name(docs, "fp"), free_name(docs, "least_row")
    number = F.col(doc_id).cast("long")
    sure = keepers.where("keeper is not null").join(repeated, keepers["keeper"] == repeated["id"], "left_anti")
    kept = docs.join(sure.select(F.col("keeper").alias(key)), number == F.col(key), "left_semi")
    if not repeated.head(1) and not keepers.where("keeper is null").head(1):
        return kept
    # an id that does not name one row: its groups choose among its rows by their own fingerprints
    again = docs.join(repeated.select(F.col("id").alias(key)), number == F.col(key), "left_semi")
    unsure = _tagged(docs.where(number.isNull()).unionByName(again), text, fp, shingle)
    groups = found.select("fp", "component").distinct().join(keepers, "component").join(
        repeated, F.col("keeper") == repeated["id"], "left").where("keeper is null or id is not null")
    group = F.struct(*[F.col(c) for c in ("fp", "component", "keeper")])
    groups = groups.select(group.alias(row))
    order = _merit(docs, text, doc_id)
    least = unsure.join(groups, (unsure[fp] == groups[row]["fp"]) & number.eqNullSafe(groups[row]["keeper"])).groupBy(
        groups[row]["component"].alias(key)).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
    return kept.unionByName(least.select(*[F.col(row)[c].alias(c) for c in docs.columns]))
