"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from the model file into arc tables:

* the normaliser writes a space in front of a text that has characters and
  rewrites spaces to the meta symbol (the model's normalisation is identity);
* the piece machine is a trie: an arc reads a character, and a node where a
  piece ends has an arc that writes its id, at weight zero.  It is compiled
  already composed with the normaliser, so its arcs read the text as it is;
* byte fallback reads any character and writes the ids of its UTF-8 bytes, at
  weight one a byte.

A bigram machine restricts what may follow: piece b may come after piece a if
the model's merges never cross their seam, which two pieces decide by
themselves (their merge histories run against each other, best score first,
leftmost on ties).  Its states are pieces; a fallback resets it.

Composed with an input, the machine has a state for each pair of a position
and a last piece.  ``shortest_path`` makes the states it needs and relaxes
their arcs in the tropical semiring: weights add along a path and the least
sum wins.  Weights are pushed first -- a character without a piece costs its
bytes on every path, so that cost is taken out of the arcs -- which makes the
arcs of most inputs free; arcs that are not free wait in a queue ordered by
weight.  The least path is the model's encoding: pieces whose seams no merge
crosses, bytes where there is no piece.

No piece crosses a seam between a character and a space, nor a line break (it
has no piece), so the search runs on the distinct runs between those seams and
a worker remembers them up to a bound.

Decoding writes each id's bytes, turns the meta symbol back to a space and
drops the space that the normaliser had put in front.

Cases: a null or empty text has no ids and decodes to the empty text; control
strings such as ``<s>`` in a text are ordinary characters; a meta symbol in a
text reads as a space (the round trip gives a space); repeated rows and other
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hebdo.llm.bytescan import Words, text_blocks
from hebdo.llm.names import check_free
from hebdo.llm.word_memory import WordMemory

META = "▁"
BLOCK = 1 << 20
PAIR = 1 << 20
REMEMBER_RUNS = 900_000
REMEMBER_PAIRS = 500_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_WORKER: dict[str, Transducer] = {}


class Transducer:
    """The composed transducers of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces \
                or not rules.add_dummy_prefix or trainer.treat_whitespace_as_suffix:
            raise ValueError("a normaliser other than identity with a dummy prefix is not supported")
        if any(p.type == _USER for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.text = [p.piece for p in model.pieces]
        if any(META in p.lstrip(META) for p in self.ids) or any("\n" in p for p in self.ids):
            raise ValueError("a piece crosses a word seam")
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        # the normaliser's rewriting arcs, and the piece machine behind them: node -> {character: node}
        self.rewrites = {" ": META, META: META}
        self.arcs: list[dict[str, int]] = [{}]
        self.writes: list[int] = [-1]                             # the piece that ends at a node
        for piece, number in self.ids.items():
            self._add_piece(piece, number)
        self.single = {c for c, node in self.arcs[0].items() if self.writes[node] >= 0}
        self.histories: dict[int, tuple | None] = {}
        self.seams: dict[int, bool] = {}
        self.memory = WordMemory(self.encode_words, REMEMBER_RUNS)
        raw = [self._bytes_of(i, p) for i, p in enumerate(model.pieces)]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_at = np.concatenate(([0], np.cumsum([len(r) for r in raw])))

    def _add_piece(self, piece: str, number: int) -> None:
        node = 0
        for c in piece:
            after = self.arcs[node].get(c, -1)
            if after < 0:
                after = len(self.arcs)
                self.arcs.append({})
                self.writes.append(-1)
                self.arcs[node][c] = after
                for read, written in self.rewrites.items():       # composed: the arc reads what is rewritten to c
                    if written == c:
                        self.arcs[node][read] = after
            node = after
        self.writes[node] = number

    @staticmethod
    def _bytes_of(number: int, piece) -> bytes:
        if piece.type == _BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        return piece.piece.replace(META, " ").encode() if piece.type == _NORMAL else b""

    def history(self, piece: int) -> tuple | None:
        """Scores of the merges that build the piece, in order, and its first and last symbol
        before each and at the end; None if the merges build something else."""
        if piece not in self.histories:
            symbols, scores = list(self.text[piece]), []
            left, right = [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                best, at = None, -1
                for i in range(len(symbols) - 1):
                    s = self.score.get(symbols[i] + symbols[i + 1])
                    if s is not None and (best is None or s > best):
                        best, at = s, i
                if best is None:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                scores.append(best)
                left.append(symbols[0])
                right.append(symbols[-1])
            self.histories[piece] = (scores, left, right) if len(symbols) == 1 else None
        return self.histories[piece]

    def seam(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a: no merge crosses their seam."""
        key = a * PAIR + b
        known = self.seams.get(key)
        if known is None:
            if len(self.seams) > REMEMBER_PAIRS:
                self.seams.clear()
            known = self.seams[key] = self._seam(self.history(a), self.history(b))
        return known

    def _seam(self, a: tuple | None, b: tuple | None) -> bool:
        if a is None or b is None:
            return False
        (sa, _, right), (sb, left, _) = a, b
        i = j = 0
        while True:
            cross = self.score.get(right[i] + left[j])
            na = sa[i] if i < len(sa) else None
            nb = sb[j] if j < len(sb) else None
            if cross is not None and (na is None or cross > na) and (nb is None or cross >= nb):
                return False
            if na is None and nb is None:
                return True
            if nb is None or na is not None and na >= nb:
                i += 1
            else:
                j += 1

    def follows(self, last: int, piece: int) -> bool:
        """The bigram machine's arc: ``piece`` after ``last``, or at the start or after bytes (-1)."""
        return self.seam(last, piece) if last >= 0 else self.history(piece) is not None

    def fallback(self, character: str) -> tuple[int, list[int]]:
        """The fallback machine's arc for a character: its weight and the ids it writes."""
        raw = self.rewrites.get(character, character).encode()
        return len(raw), [self.byte_ids[x] for x in raw]

    def piece_arcs(self, run: str, start: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of the composed piece arcs that leave a position, shortest first."""
        arcs, writes, node = self.arcs, self.writes, 0
        for end in range(start, len(run)):
            node = arcs[node].get(run[end], -1)
            if node < 0:
                return
            if writes[node] >= 0:
                yield end + 1, writes[node]

    def shortest_path(self, run: str) -> list[int]:
        """Ids of a run: the least-weight path of the machine composed with it."""
        return self.least_path(run)[1]

    def least_path(self, run: str) -> tuple[int, list[int]]:
        """(weight, ids) of the least-weight path through the composition with ``run``."""
        arcs, writes, single, seam, n = self.arcs, self.writes, self.single, self.seam, len(run)
        came: dict[tuple[int, int], tuple[int, int]] = {(0, -1): (0, -1)}
        free, queue, weight = [(0, -1)], [], 0
        while True:
            while free:                                           # states at the present pushed weight
                state = free.pop()
                start, last = state
                if start == n:
                    return weight + self._pushed(run), self._ids_of(run, came, state)
                node = 0
                for end in range(start, n):                       # piece arcs: no weight, longest tried first
                    node = arcs[node].get(run[end], -1)
                    if node < 0:
                        break
                    piece = writes[node]
                    if piece >= 0 and (end + 1, piece) not in came and (
                            seam(last, piece) if last >= 0 else self.history(piece) is not None):
                        came[end + 1, piece] = state
                        free.append((end + 1, piece))
                after = (start + 1, -1)                           # the fallback arc
                if run[start] not in single:
                    if after not in came:                         # its weight is pushed out
                        came[after] = state
                        free.append(after)
                else:
                    heapq.heappush(queue, (weight + self.fallback(run[start])[0], after, state))
            weight, after, state = heapq.heappop(queue)
            if after not in came:
                came[after] = state
                free.append(after)

    def _pushed(self, run: str) -> int:
        """The weight that every path has: the bytes of the characters without a piece."""
        return sum(self.fallback(c)[0] for c in run if c not in self.single)

    def _ids_of(self, run: str, came: dict, state: tuple[int, int]) -> list[int]:
        out: list[int] = []
        while state[0]:
            end, piece = state
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(reversed(self.fallback(run[end - 1])[1]))
            state = came[state]
        return out[::-1]

    def encode_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        raw = data.tobytes()
        paths = [self.shortest_path(raw[s:e].decode())
                 for s, e in zip(start.tolist(), end.tolist())]
        size = np.array([len(p) for p in paths], dtype=np.int64)
        flat = np.array([x for p in paths for x in p], dtype=np.uint32)
        return flat, np.cumsum(size) - size, size

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, row offsets)."""
        return self.memory.rows(_Runs(data, offsets))

    def decode_rows(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows, row offsets)."""
        size = np.diff(self.raw_at)[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        out = self.raw[np.repeat(self.raw_at[:-1][ids] - ends[:-1], size) + np.arange(int(ends[-1]))]
        rows = ends[at]
        lead = rows[:-1][np.diff(at) > 0]                         # the normaliser's space
        lead = lead[out[lead] == 0x20]
        keep = np.ones(len(out), dtype=bool)
        keep[lead] = False
        return out[keep], rows - np.searchsorted(lead, rows, side="left")


class _Runs(Words):
    """The runs between seams: spaces and the characters after them, or one line break.

    Every row that has characters gets the normaliser's space in front."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        size = np.diff(offsets)
        some = size > 0
        self.data = np.insert(data, offsets[:-1][some], 0x20)
        self.offsets = offsets + np.concatenate(([0], np.cumsum(some)))
        d = self.data
        space, line = d == 0x20, d == 0x0A
        begins = line.copy()
        begins[1:] |= (space[1:] & ~space[:-1]) | (~space[1:] & line[:-1])
        begins[self.offsets[:-1][some]] = True
        self.start = np.flatnonzero(begins)
        self.end = np.concatenate((self.start[1:], [len(d)])) if len(d) else self.start
        self.bounds = np.searchsorted(self.start, self.offsets)


def _transducer(path: str) -> Transducer:
    if path not in _WORKER:
        _WORKER[path] = Transducer(path)
    return _WORKER[path]


def _plain(column: pa.Array) -> pa.Array:
    column = column.fill_null("")
    return pc.replace_substring(column, META, " ") if pc.any(pc.match_substring(column, META)).as_py() else column


def encode(docs: DataFrame, model: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``piece_ids`` of every row."""
    check_free(keep, ["piece_ids"])
    schema = docs.select(*keep).schema.add("piece_ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _transducer(model)
        for b in batches:
            for lo, data, offsets in text_blocks(_plain(b.column(text)), BLOCK):
                ids, at = fst.encode_block(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(lo, len(at) - 1) for c in keep] + [lists], names=[*keep, "piece_ids"])
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, keep: list[str], ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """The columns ``keep`` and the decoded ``text`` of every row (null ids: empty)."""
    check_free(keep, [text])
    schema = rows.select(*keep).schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _transducer(model)
        for b in batches:
            column = b.column(ids)
            at = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(
                zero_copy_only=False)))).astype(np.int64)
            raw, ends = fst.decode_rows(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at)
            raw = raw.tobytes()
            texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(texts, pa.string())],
                                             names=[*keep, text])
    return rows.mapInArrow(run, schema)


MADE = ["piece_ids", "n_ids", "round_trip"]


def encode_and_check(docs: DataFrame, model: str, keep: list[str], text: str = "text",
                     made: list[str] | None = None) -> DataFrame:
    """``encode`` plus n_ids and ``round_trip``: decoding the ids gives the text (spaces for meta symbols).

    ``made`` gives the three new columns other names."""
    made = made or MADE
    check_free(keep, made)
    ids_col, n_col, same_col = made
    schema = docs.select(*keep).schema.add(ids_col, T.ArrayType(T.IntegerType())).add(n_col, "long").add(
        same_col, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _transducer(model)
        for b in batches:
            for lo, data, offsets in text_blocks(_plain(b.column(text)), BLOCK):
                ids, at = fst.encode_block(data, offsets)
                raw, ends = fst.decode_rows(ids, at)
                if np.array_equal(ends, offsets) and np.array_equal(raw, data):
                    same = np.ones(len(at) - 1, dtype=bool)
                else:
                    same = np.array([np.array_equal(raw[s:e], data[x:y]) for s, e, x, y in zip(
                        ends[:-1], ends[1:], offsets[:-1], offsets[1:])])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(lo, len(at) - 1) for c in keep] + [lists, pa.array(np.diff(at)), pa.array(same)],
                    names=[*keep, *made])
    return docs.mapInArrow(run, schema)
