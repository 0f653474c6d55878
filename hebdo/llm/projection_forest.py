"""Approximate nearest neighbours: a forest of random-projection trees behind one priority queue.

Index.  Each tree splits the unit vectors by hyperplanes halfway through the
projections of a sample on the difference of two of its members, down to
leaves of about ``LEAF_ROWS`` rows of the whole table (``MAX_LEAVES`` at
most).  The hyperplanes are fitted on ``SAMPLE_A_LEAF`` rows a leaf, taken by
the hash of the vector's id: a bounded sample.  Every row is indexed: it goes
to one leaf of each tree, and a leaf above ``BUCKET_ROWS`` rows is dealt by
row to as many buckets as it needs.

Search.  All trees share one queue: a node's priority is the least margin by
which the query lies on its side of the hyperplanes above, the best node of
any tree is opened next, and a query visits the first ``visits`` leaves that
come up.  Query blocks and row blocks meet by bucket; each query's candidates
of a bucket are scored against the original vectors, and the best of all
buckets are merged.

``visits`` is not a constant, for the number of leaves that holds the
neighbours depends on the data: ``SAMPLE_QUERIES`` queries, chosen by hash,
get their exact neighbours in one linear pass; the queue tells after how many
leaves each of those would have been reached; ``visits`` is the number that
reaches the share ``RECALL`` of them.  On data without structure that is a
large part of all leaves, on clustered data a small one.

Scores are cosines in double precision: components are scaled by a power of
two, so no square overflows, and products are added component by component,
so equal vectors get equal scores wherever they lie.  A matrix product only
chooses whom to score; its rounding is allowed for.

Cases: rows whose vector is null, empty, zero or holds a null, NaN or
infinite component take no part; vectors of several lengths raise ValueError;
a row without an id is a candidate for none and no query; rows that share an
id are one another's candidates no more than their own, and as queries they
search one by one but return the best of their results under that id; equal
vectors tie and go by ascending id; fewer candidates than ``top`` are all
returned.  Ids are integers.  Columns that are not named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.vectors import finite, matrix
from hebdo.session import materialize

TOP, EVERY = 5, 50
TREES = 4
LEAF_ROWS = 512
MAX_LEAVES = 1024
SAMPLE_A_LEAF = 32
SAMPLE_QUERIES = 512
RECALL = 0.96
BUCKET_ROWS = 16_384
SEED = 13
QUERY_BLOCK = 256
_NEAR = 1e-9                    # far above the rounding of a matrix product of unit vectors


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; scaled by a power of two first, so no square overflows."""
    out = vectors.astype(np.float64)
    top = np.abs(out).max(axis=1, initial=0.0)
    out = np.ldexp(out, -np.frexp(top)[1][:, None])
    return out / np.sqrt(_dots(out, out))[:, None]


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, added component by component."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each query with the row beside it, on the original vectors."""
    def scaled(x):
        x = x.astype(np.float64)
        return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])
    q, r = scaled(queries), scaled(rows)
    return _dots(q, r) / (np.sqrt(_dots(q, q)) * np.sqrt(_dots(r, r)))


class Forest:
    """Complete binary trees of one depth: node n has the children 2n + 1 and 2n + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = SEED):
        inner, width = (1 << depth) - 1, sample.shape[1]
        self.depth, self.trees, self.leaves = depth, trees, 1 << depth
        self.normal = np.zeros((trees, inner, width))
        self.cut = np.zeros((trees, inner))
        rng = np.random.default_rng(seed)
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                m = members.pop(node)
                normal = rng.standard_normal(width)
                if len(m) > 1:
                    a, b = sample[rng.choice(m, 2, replace=False)]
                    if (a != b).any():
                        normal = a - b
                normal /= max(np.sqrt((normal * normal).sum()), 1e-300)
                at = sample[m] @ normal
                self.normal[t, node] = normal
                self.cut[t, node] = np.median(at) if len(m) else 0.0
                right = at > self.cut[t, node]
                members[2 * node + 1], members[2 * node + 2] = m[~right], m[right]

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        """Leaf number in each tree (rows x trees); a row on a hyperplane goes left."""
        out = np.zeros((len(unit), self.trees), dtype=np.int64)
        for t in range(self.trees):
            node = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                at = np.zeros(len(unit))
                for j in range(unit.shape[1]):        # in a fixed order: equal rows take equal paths
                    at += unit[:, j] * self.normal[t, node, j]
                node = 2 * node + 1 + (at > self.cut[t, node])
            out[:, t] = node - (self.leaves - 1)
        return out

    def margins(self, unit: np.ndarray) -> np.ndarray:
        """Signed distances to all hyperplanes: rows x trees x inner nodes."""
        flat = self.normal.reshape(-1, unit.shape[1])
        return (unit @ flat.T).reshape(len(unit), self.trees, -1) - self.cut[None]

    def visits(self, margins: np.ndarray) -> Iterator[int]:
        """Leaves (tree * leaves + leaf) in the order in which the shared queue opens them."""
        inner = self.leaves - 1
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        rows = margins.tolist()
        while queue:
            priority, t, node = heapq.heappop(queue)
            if node >= inner:
                yield t * self.leaves + node - inner
                continue
            side = rows[t][node]
            heapq.heappush(queue, (max(priority, side), t, 2 * node + 1))
            heapq.heappush(queue, (max(priority, -side), t, 2 * node + 2))


class Rows:
    """Candidate rows of a bucket: at most ``top`` + 1 of each distinct vector, those with the smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int):
        vectors = np.ascontiguousarray(vectors)
        key = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1])))[:, 0]
        order = np.argsort(ids, kind="stable")
        order = order[np.argsort(key[order], kind="stable")]
        ranked = key[order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        begin = np.flatnonzero(first)[np.cumsum(first) - 1]
        # an id may come several times: only the place among different ids counts
        fresh = np.concatenate(([True], (ranked[1:] != ranked[:-1]) | (ids[order][1:] != ids[order][:-1])))
        nth = np.cumsum(fresh) - np.cumsum(fresh)[begin]
        order = order[fresh & (nth <= top)]
        self.ids, self.vectors, self.unit = ids[order], vectors[order], units(vectors[order])
        self.by_id = np.argsort(self.ids, kind="stable")
        self.id_at = np.flatnonzero(np.diff(self.ids[self.by_id], prepend=self.ids.min() - 1))
        self.repeats = len(self.id_at) < len(self.ids)

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, top: int):
        """(query id, row id, score) of each query's best rows among these."""
        out = []
        for lo in range(0, len(ids), QUERY_BLOCK):
            q, own = vectors[lo:lo + QUERY_BLOCK], ids[lo:lo + QUERY_BLOCK]
            close = units(q) @ self.unit.T
            close[own[:, None] == self.ids[None, :]] = -2.0
            # rows of one id count once, by their best score
            merit = np.maximum.reduceat(close[:, self.by_id], self.id_at, axis=1) if self.repeats else close
            nth = max(0, merit.shape[1] - top)
            bar = np.partition(merit, nth, axis=1)[:, nth] - _NEAR
            i, j = np.nonzero((close >= bar[:, None]) & (close > -1.5))
            score = cosines(q[i], self.vectors[j])
            order = np.lexsort((self.ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            keep = _first_of_ids(i, self.ids[j], top)
            out.append((own[i[keep]], self.ids[j[keep]], score[keep]))
        return [np.concatenate(x) for x in zip(*out)]


def _first_of_ids(group: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """In groups ordered by merit: the first row of each id, ``top`` ids a group."""
    if not len(ids):
        return np.zeros(0, dtype=bool)
    order = np.lexsort((np.arange(len(ids)), ids, group))
    new = np.concatenate(([True], (group[order][1:] != group[order][:-1]) | (ids[order][1:] != ids[order][:-1])))
    first = np.zeros(len(ids), dtype=bool)
    first[order[new]] = True
    count = np.cumsum(first)
    start = np.searchsorted(group, group)
    return first & (count - (count[start] - first[start]) <= top)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("i").to_numpy(zero_copy_only=False)


_FOUND = "query_id bigint, vec_id bigint, score double"


def _found_batch(q, r, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.float64())],
                                      names=["query_id", "vec_id", "score"])


class _Merged:
    """The best rows of each query so far; handed out when many queries are held."""

    def __init__(self, top: int, limit: int = 200_000):
        self.top, self.limit, self.parts, self.rows = top, limit, [], 0

    def add(self, found) -> None:
        self.parts.append(found)
        self.rows += len(found[0])
        if self.rows > self.limit:
            self.parts = [self.reduced()]
            self.rows = len(self.parts[0][0])

    def reduced(self):
        q, r, s = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((r, -s, q))
        q, r, s = q[order], r[order], s[order]
        keep = _first_of_ids(q, r, self.top)
        return q[keep], r[keep], s[keep]

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield _found_batch(*self.reduced())
            self.parts, self.rows = [], 0

    def full(self) -> bool:
        return self.rows > self.limit // 2


def _merge(found: DataFrame, top: int) -> DataFrame:
    """Best rows of each query over all tasks: (query_id, rank, vec_id, score)."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def exact_neighbours(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, top: int) -> DataFrame:
    """Neighbours of a bounded list of queries by one linear pass over (i, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _Merged(top)
        for batch in batches:
            if batch.num_rows:
                merged.add(Rows(_ids(batch), matrix(batch.column("v")), top).nearest(ids, vectors, top))
        yield from merged.batches()
    return _merge(rows.mapInArrow(run, _FOUND), top)


def _bounded(rows: DataFrame, n: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """About ``n`` rows of ``of``, at most twice as many, chosen by the hash of the id: (ids, vectors)."""
    share = min(1.0, 1.2 * n / max(of, 1))
    spread = F.pmod(F.xxhash64(F.col("i"), F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    got = rows.where(spread).orderBy(F.xxhash64("i"), "i").limit(n).toArrow()
    if not got.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    got = got.combine_chunks().to_batches()[0]
    order = np.argsort(_ids(got), kind="stable")
    return _ids(got)[order], matrix(got.column("v"))[order]


def calibrated_visits(forest: Forest, queries: np.ndarray, neighbours: list[np.ndarray], recall: float) -> int:
    """Leaves to visit so that ``recall`` of the given neighbours (vectors, a list a query) are met."""
    reached: list[int] = []
    for lo in range(0, len(queries), QUERY_BLOCK):
        margins = forest.margins(units(queries[lo:lo + QUERY_BLOCK]))
        for m, near in zip(margins, neighbours[lo:lo + QUERY_BLOCK]):
            if not len(near):
                continue
            at = {leaf: n for n, leaf in enumerate(forest.visits(m), 1)}
            leaves = forest.leaf_of(units(near)) + np.arange(forest.trees) * forest.leaves
            reached += [min(at[x] for x in row) for row in leaves.tolist()]
    if not reached:
        return forest.trees * forest.leaves
    reached.sort()
    return reached[min(len(reached) - 1, int(np.ceil(recall * len(reached))))]


def _leaf_sizes(rows: DataFrame, forest: Forest) -> np.ndarray:
    """Rows of every leaf of every tree: trees x leaves counts, summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(forest.trees * forest.leaves, dtype=np.int64)
        for batch in batches:
            leaf = forest.leaf_of(units(matrix(batch.column("v")))) if batch.num_rows else np.zeros((0, forest.trees))
            flat = (leaf + np.arange(forest.trees) * forest.leaves).astype(np.int64).ravel()
            count += np.bincount(flat, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["leaf", "n"])
    out = np.zeros(forest.trees * forest.leaves, dtype=np.int64)
    for r in rows.select("v").mapInArrow(run, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        out[r["leaf"]] = r["n"]
    return out


def _grouped(bucket: np.ndarray, kind: int, row: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """One row a bucket: the ids and vectors of its members as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket, row = bucket[order], row[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*at[1:].tolist(), len(bucket)]
    spans = list(zip(at.tolist(), ends))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[at], pa.int64()), pa.array(np.full(len(at), kind), pa.int32()),
         pa.array([ids[row[a:b]].astype("<i8").tobytes() for a, b in spans], pa.binary()),
         pa.array([vectors[row[a:b]].tobytes() for a, b in spans], pa.binary())],
        names=["bucket", "kind", "ids", "vectors"])


def _members(rows: DataFrame, forest: Forest, first: np.ndarray, cuts: np.ndarray, visits: int, every: int) -> DataFrame:
    """Row blocks (kind 0) and query blocks (kind 1) by bucket; leaf x has the buckets first[x] + 0..cuts[x]-1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = _ids(batch), matrix(batch.column("v"))
            unit = units(vectors)
            leaf = (forest.leaf_of(unit) + np.arange(forest.trees) * forest.leaves).ravel()
            row = np.repeat(np.arange(len(ids)), forest.trees)
            # dealt by row: a hot vector or id spreads over all buckets of its leaf
            yield _grouped(first[leaf] + row % cuts[leaf], 0, row, ids, vectors)
            asked = np.flatnonzero(ids % every == 0)
            for lo in range(0, len(asked), QUERY_BLOCK):
                some = asked[lo:lo + QUERY_BLOCK]
                seen, who = [], []
                for m, i in zip(forest.margins(unit[some]), some.tolist()):
                    for _, x in zip(range(visits), forest.visits(m)):
                        seen.append(np.arange(first[x], first[x] + cuts[x]))
                        who.append(np.full(cuts[x], i))
                if seen:
                    yield _grouped(np.concatenate(seen), 1, np.concatenate(who), ids, vectors)
    return rows.mapInArrow(run, "bucket bigint, kind int, ids binary, vectors binary")


def _searched(members: DataFrame, dtype: np.dtype, width: int, top: int) -> DataFrame:
    """(query_id, vec_id, score): the best rows of each query in the buckets of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, now, parts, rows = _Merged(top), None, [], None
        for batch in batches:
            for bucket, kind, ids, vectors in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if bucket != now:
                    now, parts, rows = bucket, [], None
                ids = np.frombuffer(ids, dtype="<i8")
                vectors = np.frombuffer(vectors, dtype=dtype).reshape(len(ids), width)
                if kind == 0:
                    parts.append((ids, vectors))
                    continue
                if rows is None and parts:
                    rows, parts = Rows(*(np.concatenate(x) for x in zip(*parts)), top), []
                if rows is not None:
                    merged.add(rows.nearest(ids, vectors, top))
                    if merged.full():
                        yield from merged.batches()
        yield from merged.batches()
    ordered = members.repartition("bucket").sortWithinPartitions("bucket", "kind")
    return ordered.mapInArrow(run, _FOUND)


def neighbours(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", *, every: int = EVERY,
               top: int = TOP, trees: int = TREES, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES,
               recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows of every row whose id ``every`` divides."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("i"), F.col(vector).alias("v")).where(
        F.col("i").isNotNull() & finite("v") & F.exists("v", lambda x: x.cast("double") != 0))
    facts = rows.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if facts["n"] and facts["lo"] != facts["hi"]:
        raise ValueError(f"vectors have {facts['lo']} to {facts['hi']} components")
    n, width = facts["n"], facts["lo"] or 1
    depth = int(np.clip(np.floor(np.log2(max(1.0, n / leaf_rows))), 0, np.log2(max_leaves)))
    _, sample = _bounded(rows, SAMPLE_A_LEAF << depth, n)
    dtype = sample.dtype if n else np.dtype(np.float64)
    forest = Forest(units(sample) if len(sample) else np.zeros((0, width)), trees, depth)
    asked = rows.where(F.pmod("i", F.lit(every)) == 0)
    visits = trees * forest.leaves
    ids, queries = _bounded(asked, SAMPLE_QUERIES, -(-n // every)) if depth else (np.zeros(0, np.int64), sample)
    if len(ids):
        true = materialize(exact_neighbours(rows, ids, queries, top))
        true = rows.withColumnRenamed("i", "vec_id").join(F.broadcast(true), "vec_id").select("query_id", "v").toArrow()
        near: dict[int, list] = {}
        for q, v in zip(true.column("query_id").to_pylist(), true.column("v").to_pylist()):
            near.setdefault(q, []).append(v)
        found = [np.array(near.get(i, []), dtype=dtype).reshape(-1, width) for i in ids.tolist()]
        visits = calibrated_visits(forest, queries, found, recall)
    cuts = np.maximum(1, -(-_leaf_sizes(rows, forest) // BUCKET_ROWS))
    first = np.concatenate(([0], np.cumsum(cuts)))[:-1]
    members = _members(rows, forest, first, cuts, visits, every)
    return _merge(_searched(members, dtype, width, top), top)
