"""Suffix-array dedup: depth-limited most-significant-digit passes over suffixes.

Tokens are bytes.  A repeated window is a string of ``window`` tokens that
also starts in a document with a smaller id; every byte under one is removed.
Suffixes are ordered only through ``window`` tokens, and only the equal groups
matter, so a suffix leaves the sort as soon as its digits so far are its own.

Sorting every suffix of a corpus would shuffle many times its size.  The sort
therefore runs over a sample that loses nothing: of the grams of ``GRAM``
tokens inside a window, the one with the least hash is the window's anchor,
so equal windows have equal anchors at equal places.  Neighbouring windows of
one document that share an anchor form one suffix of the sample, a *stretch*.
The passes, each on the groups that the previous one left:

1. digit: the anchor's gram.  A gram of one document only drops out.
2. digit: the whole stretch.  A stretch that an earlier document has is
   removed whole; of grams with one stretch only, nothing else is left to do.
3. digit: the single windows of the first stretches of each remaining group.
   Their equal groups are exactly the remaining repeated windows.

Documents are dealt in batches of consecutive ids.  A batch settles its own
repeats and sends each distinct digit once, so a string that a third of all
documents share costs one entry a batch.  The leading bits of a digit choose
its bucket (the first radix pass); a bucket sorts its entries and answers each
batch with bits, in the order in which the batch sent them.  Batches and
buckets stand for a bounded number of bytes, whatever the size of the input,
and all passes read one shuffle of the texts.

A batch sends at most ``FAN`` messages a pass.  An input with more buckets is
sorted by two exchanges: the leading bits choose a relay, which takes the
messages of ``FAN`` batches, splits them by the next bits and sends each
bucket one message for all of them; answers come back the same way.  Messages
so grow with the input, not with its square.

An id that rows of more than a batch share has several batches of its own.
They have one place in the order of batches, so none of them is earlier than
another.

Digits are hashes of their tokens.  Pass 1 only proposes (32 bits and the
bucket's).  What is removed agrees in the anchor's 32 bits, the bucket's bits
and the 64 bits of its stretch (pass 2), or in two independent hashes of 64
bits each of its window (pass 3); the tokens themselves are not compared.

Cases: a null text is empty; texts shorter than the window keep all bytes;
repeats within one document do not count; rows with one id are not smaller
than each other, so they never remove from each other; a row without an id
is no source and keeps its text, it takes no part in the passes; other columns
pass through; ids are integers; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.llm.bytescan import mix, prefix_sums, row_blocks, utf8_buffer
from hebdo.llm.names import free_name
from hebdo.session import materialize

WINDOW = 50
GRAM = 25
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
SCAN_BYTES = 1 << 17            # a batch is scanned in blocks: their arrays hold 8 bytes for each byte of text
BUCKETS = 1024                  # more only when a bucket would pass LARGE_BUCKET bytes of text
LARGE_BUCKET = 64 << 20
SPLIT = 4096
CUTS = 3
FAN = 1024
SPREAD = np.uint64(0xD6E8FEB86659FD93)
SECOND_BASE = np.uint64(0xA0761D6478BD642F)
BATCH_KEY = "struct<cell:bigint,owner:bigint,cut:int>"
MESSAGE = f"bucket bigint, batch {BATCH_KEY}, kind int, body binary"


class Stretches:
    """The sample of one block: anchor gram, stretch and window digits."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.data, self.window, n, gram = data, window, len(data), min(GRAM, window)
        self.first = self.last = self.doc = np.zeros(0, np.int64)
        self.gram = self.digit = np.zeros(0, np.uint64)
        if n < window:
            return
        sums, down = prefix_sums(data)
        bits = np.uint64(n.bit_length())
        h = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
        low = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
        width, have = window - gram + 1, 1
        while have < width:                                       # sliding minimum over a window's grams
            step = min(have, width - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        fits = np.arange(len(at)) <= np.repeat(offsets[1:], np.diff(offsets))[:len(at)] - window
        start = np.flatnonzero(fits)
        if not len(start):
            return
        doc = np.searchsorted(offsets, start, side="right") - 1
        at = at[start]
        begin = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))))
        end = np.concatenate((begin[1:], [len(start)])) - 1
        self.first, self.last, self.doc, at = start[begin], start[end], doc[begin], at[begin]
        self.gram = mix(h[at] * SPREAD)                           # an anchor's own hash is small: it was the least
        # second digit: the tokens of the whole stretch and the anchor's place in it
        whole = (sums[self.last + window] - sums[self.first]) * down[self.first]
        shape = (at - self.first) * window * 2 + (self.last - self.first) + 1
        self.digit = mix(whole ^ mix(shape.astype(np.uint64)))

    def __len__(self) -> int:
        return len(self.first)

    def windows(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Third digits of the stretches ``k``: position in k, start, two hashes of each window."""
        size = self.last[k] - self.first[k] + 1
        owner = np.repeat(np.arange(len(k)), size)
        start = np.repeat(self.first[k] - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())
        digit = np.empty((len(start), 2), dtype=np.uint64)
        for i, sums_down in enumerate((prefix_sums(self.data), prefix_sums(self.data, SECOND_BASE))):
            sums, down = sums_down
            digit[:, i] = mix((sums[start + self.window] - sums[start]) * down[start])
        return owner, start, digit


class Batch:
    """All stretches of a batch; documents are numbered by the order of their ids."""

    def __init__(self, table: pa.Table, doc_id: str, text: str, window: int, bucket_bits: int):
        self.bits, self.window = bucket_bits, window
        ids = np.array(table.column(doc_id).to_pylist(), dtype=object)
        known = np.array([i is not None for i in ids], dtype=bool)
        order = np.unique(ids[known].astype(np.int64)) if known.any() else np.zeros(0, np.int64)
        rank = np.full(len(ids), -1)
        rank[known] = np.searchsorted(order, ids[known].astype(np.int64))
        self.data, self.offsets = utf8_buffer(table.column(text).combine_chunks()
                                              if table.num_rows else pa.array([], pa.string()))
        self.blocks, self.row_of_block = [], []
        for lo, hi in row_blocks(self.offsets, SCAN_BYTES):
            self.row_of_block.append(lo)
            self.blocks.append(Stretches(self.data[self.offsets[lo]:self.offsets[hi]],
                                         self.offsets[lo:hi + 1] - self.offsets[lo], window))
        self.row = self._all(lambda b, lo: b.doc + lo, np.int64)
        self.doc = rank[self.row] if len(self.row) else self.row
        self.gram = self._all(lambda b, lo: b.gram, np.uint64)
        self.digit = self._all(lambda b, lo: b.digit, np.uint64)
        base = [int(self.offsets[lo]) for lo in self.row_of_block]
        self.first = self._all(lambda b, lo: b.first + int(self.offsets[lo]), np.int64)
        self.last = self._all(lambda b, lo: b.last + int(self.offsets[lo]), np.int64)
        self.block = np.repeat(np.arange(len(base)), [len(b) for b in self.blocks]) if base else self.row
        use = self.doc >= 0
        if not use.all():
            for name in ("row", "doc", "gram", "digit", "first", "last", "block"):
                setattr(self, name, getattr(self, name)[use])
        self.within = np.concatenate([np.arange(len(b)) for b in self.blocks])[use] if base else self.row
        self.grams, self.gram_no = np.unique(self.gram, return_inverse=True)

    def _all(self, get, kind) -> np.ndarray:
        parts = [get(b, lo) for b, lo in zip(self.blocks, self.row_of_block)]
        return np.concatenate(parts) if parts else np.zeros(0, kind)

    def bucket_bounds(self, digits: np.ndarray) -> np.ndarray:
        """Sorted digits of bucket k are bounds[k]:bounds[k + 1]."""
        return np.searchsorted(digits >> np.uint64(64 - self.bits) if self.bits else digits * np.uint64(0),
                               np.arange((1 << self.bits) + 1, dtype=np.uint64))

    def survivors(self, shared: np.ndarray) -> None:
        """After pass 1: keep the stretches whose gram more than one document has; distinct pairs."""
        lo, hi = _extremes(self.gram_no, self.doc, len(self.grams))
        alive = (shared | (lo != hi))[self.gram_no] if len(self.gram_no) else np.zeros(0, bool)
        self.alive = np.flatnonzero(alive)
        order = self.alive[np.lexsort((self.doc[self.alive], self.digit[self.alive], self.gram_no[self.alive]))]
        g, s = self.gram_no[order], self.digit[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (s[1:] != s[:-1]))) if len(g) else np.zeros(0, bool)
        self.order, self.pair_no = order, np.cumsum(new) - 1
        self.pairs = order[np.flatnonzero(new)]                   # first occurrence, in the smallest document
        self.pair_gram, self.pair_digit = self.gram[self.pairs], self.digit[self.pairs]

    def pair_windows(self, wanted: np.ndarray):
        """(pair, start in the batch, digit) of every window of the pairs ``wanted``."""
        owner, start, digit = [], [], []
        at = self.pairs[wanted]
        for k, block in enumerate(self.blocks):
            here = np.flatnonzero(self.block[at] == k)
            if len(here):
                o, s, d = block.windows(self.within[at[here]])
                owner.append(here[o])
                start.append(s + int(self.offsets[self.row_of_block[k]]))
                digit.append(d)
        if not owner:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
        return np.concatenate(owner), np.concatenate(start), np.concatenate(digit)


def _extremes(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(lo, group, value)
    np.maximum.at(hi, group, value)
    return lo, hi


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, dtype=np.uint8), count=n).astype(bool)


def _distinct(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows of a two-column array in order, the place of each row among them)."""
    order = np.lexsort((digits[:, 1], digits[:, 0]))
    ranked = digits[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


_KEY_TYPE = pa.struct([("cell", pa.int64()), ("owner", pa.int64()), ("cut", pa.int32())])


def _messages(rows: list[tuple[int, dict, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = (pa.int64(), _KEY_TYPE, pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "batch", "kind", "body"])


REQUEST, ANSWER, STATE = 0, 1, 2


def _place(batch: dict) -> tuple[int, int]:
    """What orders batches: cuts of one id are not before each other."""
    return batch["cell"], batch["owner"]


def _own(batch: dict) -> int:
    """A bucket that only states of batches go to."""
    return -1 - (hash((batch["cell"], batch["owner"], batch["cut"])) & ((1 << 40) - 1))


def _answers(table: pa.Table) -> tuple[dict[int, bytes], bytes]:
    """Answer bodies by bucket, and the state that the batch had sent to itself."""
    found, state = {}, b""
    for r in table.to_pylist():
        if r["kind"] == STATE:
            state = r["body"]
        else:
            found[r["bucket"]] = r["body"]
    return found, state


def _bucketed(batch: Batch, digits: np.ndarray, body: Callable[[slice], bytes], number: dict):
    bounds = batch.bucket_bounds(digits)
    return [(k, number, REQUEST, body(slice(lo, hi)))
            for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if hi > lo]


def _collect_flags(batch: Batch, digits: np.ndarray, found: dict[int, bytes], part: int = 0,
                   parts: int = 1) -> np.ndarray:
    """Answer bits in the order of ``digits``; an answer holds ``parts`` bit fields."""
    bounds = batch.bucket_bounds(digits)
    out = np.zeros(len(digits), dtype=bool)
    for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if hi > lo:
            size = len(found[k]) // parts
            out[lo:hi] = _flags(found[k][part * size:(part + 1) * size], hi - lo)
    return out


def _next32(digits: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after the bucket's bits."""
    return (digits << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


class Fields:
    """Layout of a message: columns of one width each, behind one another, in the order of the first."""

    def __init__(self, *kinds: str):
        self.kinds = [np.dtype(k) for k in kinds]
        self.width = sum(k.itemsize for k in self.kinds)

    def read(self, body: bytes) -> list[np.ndarray]:
        n, at, out = len(body) // self.width, 0, []
        for k in self.kinds:
            out.append(np.frombuffer(body, k, n, at))
            at += n * k.itemsize
        return out


GRAM_FIELDS, STRETCH_FIELDS, WINDOW_FIELDS = Fields("u4"), Fields("u4", "u8"), Fields("u8", "u8")

#: a bucket's work: (places in the order of batches, columns) of every message -> answer bits of every message
Parts = list[tuple[tuple[int, int], list[np.ndarray]]]


def sort_grams(parts: Parts) -> list[list[np.ndarray]]:
    """Pass 1: the grams that more than one batch sent."""
    ranked = np.sort(np.concatenate([c[0] for _, c in parts]))    # a batch sends a digit once
    again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    last = max(len(again) - 1, 0)

    def shared(digits: np.ndarray) -> np.ndarray:
        spot = np.minimum(np.searchsorted(again, digits), last)
        return again[spot] == digits if len(again) else np.zeros(len(digits), bool)
    return [[shared(c[0])] for _, c in parts]


def _in_order(parts: Parts) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Messages in the order of batches; each entry's place in that order; the columns of all entries."""
    by_place = sorted(range(len(parts)), key=lambda i: parts[i][0])
    places = sorted({p for p, _ in parts})
    number = {p: i for i, p in enumerate(places)}
    size = [len(parts[i][1][0]) for i in by_place]
    place = np.repeat([number[parts[i][0]] for i in by_place], size)
    columns = [np.concatenate([parts[i][1][k] for i in by_place]) for k in range(len(parts[0][1]))]
    return by_place, place, columns


def _cut(by_place: list[int], parts: Parts, fields: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Bits of all entries, handed back to their messages."""
    out: list[list[np.ndarray]] = [[] for _ in parts]
    at = 0
    for i in by_place:
        n = len(parts[i][1][0])
        out[i] = [f[at:at + n] for f in fields]
        at += n
    return out


def _after_first(new: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Sorted entries that an earlier batch has too; ``new`` marks where a group begins."""
    return place != place[np.flatnonzero(new)][np.cumsum(new) - 1]


def sort_stretches(parts: Parts) -> list[list[np.ndarray]]:
    """Pass 2: the stretches that an earlier batch has; the grams that have several stretches."""
    by_place, place, (gram, digit) = _in_order(parts)
    order = np.lexsort((digit, gram))                             # stable: batches stay in order
    g, s = gram[order], digit[order]
    new_gram = np.concatenate(([True], g[1:] != g[:-1]))
    new = new_gram | np.concatenate(([True], s[1:] != s[:-1]))
    group = np.cumsum(new_gram) - 1
    several = np.bincount(group, weights=new) > 1
    before, split = np.empty(len(g), bool), np.empty(len(g), bool)
    before[order], split[order] = _after_first(new, place[order]), several[group]
    return _cut(by_place, parts, [before, split])


def sort_windows(parts: Parts) -> list[list[np.ndarray]]:
    """Pass 3: the windows that an earlier batch has."""
    by_place, place, (first, second) = _in_order(parts)
    order = np.lexsort((second, first))                           # stable: batches stay in order
    a, b = first[order], second[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    before = np.empty(len(a), dtype=bool)
    before[order] = _after_first(new, place[order])
    return _cut(by_place, parts, [before])


def _packed(bodies: list[bytes]) -> bytes:
    """Several bodies as one: their number, their sizes, then the bodies."""
    return np.array([len(bodies), *map(len, bodies)], dtype="<i8").tobytes() + b"".join(bodies)


def _unpacked(body: bytes) -> list[bytes]:
    n = int(np.frombuffer(body, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(body, "<i8", n, 8)) + 8 + 8 * n
    return [body[s:e] for s, e in zip([8 + 8 * n, *ends[:-1].tolist()], ends.tolist())]


class Exchange:
    """Messages to their buckets and the answers back, by one exchange or by relays."""

    def __init__(self, bits: int, batches: int, fan: int = FAN):
        self.bits = min(bits, (fan - 1).bit_length())              # a batch chooses among so many addresses
        self.low = bits - self.bits                                # the bits that a relay sorts by
        self.relays = max(1, -(-batches // fan))                   # relays of one address

    def answered(self, sent: DataFrame, layout: Fields, sort: Callable[[Parts], list[list[np.ndarray]]]) -> DataFrame:
        return self._relayed(sent, layout, sort) if self.low else self._direct(sent, layout, sort)

    @staticmethod
    def _direct(sent: DataFrame, layout: Fields, sort) -> DataFrame:
        def bucket(key, table):
            rows = table.to_pylist()
            if rows[0]["kind"] == STATE:
                return table
            fields = sort([(_place(r["batch"]), layout.read(r["body"])) for r in rows])
            return _messages([(r["bucket"], r["batch"], ANSWER, b"".join(map(_bits, f))) for r, f in zip(rows, fields)])
        return sent.groupBy("bucket").applyInArrow(bucket, MESSAGE)

    def _pieces(self, lead: np.ndarray) -> np.ndarray:
        """Bounds of a message's entries in each bucket of its address, by the digits' next bits."""
        wide = np.uint64(8 * lead.dtype.itemsize)
        shift = np.uint64(self.bits) if lead.dtype.itemsize == 8 else np.uint64(0)
        low = (lead.astype(np.uint64) << (np.uint64(64) - wide + shift)) >> np.uint64(64 - self.low)
        return np.searchsorted(low, np.arange((1 << self.low) + 1, dtype=np.uint64))

    def _relayed(self, sent: DataFrame, layout: Fields, sort) -> DataFrame:
        relays = self.relays
        sent = sent.withColumn("relay", F.pmod(F.xxhash64("batch"), F.lit(relays)).cast("int"))
        packet = "bucket bigint, address bigint, relay int, places binary, body binary"

        def split(key, table):
            address, relay = key[0].as_py(), key[1].as_py()
            rows = [r for r in table.to_pylist() if r["kind"] == REQUEST]
            out: list[tuple[int, bytes, bytes]] = []
            columns = [layout.read(r["body"]) for r in rows]
            bounds = [self._pieces(c[0]) for c in columns]
            for low in range(1 << self.low):
                have = [i for i, b in enumerate(bounds) if b[low + 1] > b[low]]
                if have:
                    places = np.array([_place(rows[i]["batch"]) for i in have], dtype="<i8")
                    bodies = [b"".join(c[bounds[i][low]:bounds[i][low + 1]].tobytes() for c in columns[i]) for i in have]
                    out.append(((address << self.low) | low, places.tobytes(), _packed(bodies)))
            return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([address] * len(out), pa.int64()),
                             pa.array([relay] * len(out), pa.int32()), pa.array([o[1] for o in out], pa.binary()),
                             pa.array([o[2] for o in out], pa.binary())],
                            names=["bucket", "address", "relay", "places", "body"])

        def bucket(key, table):
            rows, parts, owner = table.to_pylist(), [], []
            for i, r in enumerate(rows):
                places = np.frombuffer(r["places"], "<i8").reshape(-1, 2).tolist()
                for place, body in zip(places, _unpacked(r["body"])):
                    parts.append((tuple(place), layout.read(body)))
                    owner.append(i)
            bodies: list[list[bytes]] = [[] for _ in rows]
            for i, fields in zip(owner, sort(parts)):
                bodies[i].append(b"".join(map(_bits, fields)))
            return table.set_column(table.schema.get_field_index("body"), "body",
                                    pa.array([_packed(b) for b in bodies], pa.binary()))

        def back(key, left, right):
            rows = left.to_pylist()
            asked = [r for r in rows if r["kind"] == REQUEST]
            out = [(r["bucket"], r["batch"], STATE, r["body"]) for r in rows if r["kind"] == STATE]
            bounds = [self._pieces(layout.read(r["body"])[0]) for r in asked]
            bits: list[list[np.ndarray]] = [[] for _ in asked]
            answers = {r["bucket"] & ((1 << self.low) - 1): _unpacked(r["body"]) for r in right.to_pylist()}
            # a piece's answer holds as many bit fields as its message's, each filled up to whole bytes
            for low, bodies in sorted(answers.items()):
                have = [i for i, b in enumerate(bounds) if b[low + 1] > b[low]]
                for i, body in zip(have, bodies):
                    n = int(bounds[i][low + 1] - bounds[i][low])
                    each = -(-n // 8)
                    bits[i].append(np.stack([_flags(body[k:k + each], n) for k in range(0, len(body), each)]))
            for r, pieces in zip(asked, bits):
                whole = np.concatenate(pieces, axis=1)
                out.append((r["bucket"], r["batch"], ANSWER, b"".join(map(_bits, whole))))
            return _messages(out)

        split_up = sent.groupBy("bucket", "relay").applyInArrow(split, packet)
        sorted_up = split_up.groupBy("bucket").applyInArrow(bucket, packet)
        return sent.groupBy("bucket", "relay").cogroup(sorted_up.groupBy("address", "relay")).applyInArrow(back, MESSAGE)


class Passes:
    """The functions that run on batches."""

    def __init__(self, doc_id: str, text: str, window: int, bucket_bits: int):
        self.doc_id, self.text, self.window, self.bits = doc_id, text, window, bucket_bits

    def _batch(self, docs: pa.Table) -> Batch:
        return Batch(docs, self.doc_id, self.text, self.window, self.bits)

    # pass 1
    def send_grams(self, number: dict, docs: pa.Table) -> pa.Table:
        b = self._batch(docs)
        return _messages(_bucketed(b, b.grams, lambda s: _next32(b.grams[s], self.bits).tobytes(), number))

    # pass 2
    def send_stretches(self, number: dict, docs: pa.Table, table: pa.Table) -> pa.Table:
        b = self._batch(docs)
        shared = _collect_flags(b, b.grams, _answers(table)[0])
        b.survivors(shared)
        rows = _bucketed(b, b.pair_gram, lambda s: _next32(b.pair_gram[s], self.bits).tobytes()
                         + b.pair_digit[s].tobytes(), number)
        return _messages(rows + [(_own(number), number, STATE, _bits(shared))])

    def _after_two(self, docs: pa.Table, found: dict[int, bytes], state: bytes):
        b = self._batch(docs)
        shared = _flags(state, len(b.grams))
        b.survivors(shared)
        before = _collect_flags(b, b.pair_gram, found, 0, 2)
        split = _collect_flags(b, b.pair_gram, found, 1, 2)
        return b, shared, before, split

    # pass 3
    def send_windows(self, number: dict, docs: pa.Table, table: pa.Table) -> pa.Table:
        b, shared, before, split = self._after_two(docs, *_answers(table))
        _, _, digit = b.pair_windows(np.flatnonzero(split & ~before))
        digit, _ = _distinct(digit)
        rows = _bucketed(b, digit[:, 0], lambda s: digit[s, 0].tobytes() + digit[s, 1].tobytes(), number)
        state = _bits(shared) + _bits(before) + _bits(split)
        return _messages(rows + [(_own(number), number, STATE, state)])

    # the result
    def removed(self, docs: pa.Table, table: pa.Table) -> tuple[Batch, np.ndarray]:
        """The batch and a flag for each byte that a repeated window covers."""
        found, state = _answers(table)
        b = self._batch(docs)
        cut = np.zeros(len(b.data) + 1, dtype=np.int32)
        if not len(b.grams):
            return b, cut[:0].astype(bool) if not len(b.data) else np.zeros(len(b.data), bool)
        n = -(-len(b.grams) // 8)
        b.survivors(_flags(state[:n], len(b.grams)))
        m = -(-len(b.pairs) // 8)
        before = _flags(state[n:n + m], len(b.pairs))
        split = _flags(state[n + m:], len(b.pairs))
        # whole stretches: known from an earlier batch, or not in the pair's first document here
        whole = before[b.pair_no] | (b.doc[b.order] != b.doc[b.pairs][b.pair_no])
        k = b.order[whole]
        np.add.at(cut, b.first[k], 1)
        np.add.at(cut, b.last[k] + self.window, -1)
        wanted = np.flatnonzero(split & ~before)
        owner, start, digit = b.pair_windows(wanted)
        if len(digit):
            kinds, no = _distinct(digit)
            seen = _collect_flags(b, kinds[:, 0], found)
            doc = b.doc[b.pairs[wanted]][owner]
            least, _ = _extremes(no, doc, len(kinds))
            hit = seen[no] | (least[no] < doc)
            # every stretch of the pair in its first document has the same windows
            in_first = np.flatnonzero(~whole)
            by_pair = np.argsort(b.pair_no[in_first], kind="stable")
            pair_of, member = b.pair_no[in_first][by_pair], b.order[in_first][by_pair]
            rel = start[hit] - b.first[b.pairs[wanted]][owner[hit]]
            pair = wanted[owner[hit]]
            lo, hi = np.searchsorted(pair_of, pair, "left"), np.searchsorted(pair_of, pair, "right")
            count = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(count.sum())
            begin = b.first[member[at]] + np.repeat(rel, count)
            np.add.at(cut, begin, 1)
            np.add.at(cut, begin + self.window, -1)
        return b, np.cumsum(cut[:-1], out=cut[:-1]) > 0

    def spans(self, b: Batch, gone: np.ndarray) -> list[list[tuple[int, int]]]:
        """Maximal removed runs of each row (byte positions in its text)."""
        edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out: list[list[tuple[int, int]]] = [[] for _ in range(len(b.offsets) - 1)]
        rows = np.searchsorted(b.offsets, starts, side="right") - 1
        for s, e, r in zip(starts.tolist(), ends.tolist(), rows.tolist()):
            while s < e:                                          # a run may go on in the next row
                stop = min(e, int(b.offsets[r + 1]))
                if stop > s:
                    base = int(b.offsets[r])
                    out[r].append((s - base, stop - base))
                s, r = stop, r + 1
        return out


def batched(docs: DataFrame, doc_id: str, text: str, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, str, int]:
    """``docs``, whose ids are not null, with a batch key whose cell and owner never fall as the id
    grows; the key's name; the total bytes.

    The id range is cut evenly; cells that hold much more than a batch are cut again, up to ``CUTS``
    times (ids may be sparse and clustered).  What is large even then has few ids: its rows are
    batched id by id, and the rows of an id of more than a batch are dealt to several."""
    name, more = free_name(docs, "batch_key"), free_name(docs, "batch_cuts")
    cell = free_name(docs, "batch_cell")
    key = F.col(doc_id).cast("double")                            # rounding keeps the order, and equal ids equal
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)
    s = docs.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.sum(size).alias("n")).first()
    lo, hi, total = s["lo"] or 0.0, s["hi"] or 0.0, int(s["n"] or 0)
    width = max(1.0, (hi - lo + 1) / max(1, -(-total // batch_bytes)))
    place = (key - F.lit(lo)) / F.lit(width)                      # the cell, and the place inside it
    out = docs.withColumn(cell, F.floor(place).cast("long"))
    limit, scale = 4 * batch_bytes, 1
    for n in range(CUTS + 1):
        # at most one cell for ``limit`` bytes of text
        large = out.groupBy(cell).agg(F.sum(size).alias("n")).where(F.col("n") > limit).select(cell)
        if not large.head(1):
            return out.withColumn(name, _batch_key(F.col(cell), F.lit(0), F.lit(0))).drop(cell), name, total
        if width <= 1 or n == CUTS:
            break
        scale, width = scale * SPLIT, width / SPLIT
        finer = F.floor(place * F.lit(float(scale))).cast("long")
        coarse = F.col(cell) * SPLIT
        out = out.join(F.broadcast(large.withColumn(more, F.lit(1))), cell, "left").withColumn(
            cell, F.when(F.col(more).isNotNull(), F.greatest(coarse, F.least(finer, coarse + SPLIT - 1)))
            .otherwise(coarse)).select(*docs.columns, cell)
    out = out.join(F.broadcast(large.withColumn(more, F.lit(1))), cell, "left")
    owner = F.when(F.col(more).isNotNull(), F.col(doc_id).cast("long")).otherwise(F.lit(0))
    out = out.withColumn(name, _batch_key(F.col(cell), owner, F.lit(0))).drop(cell, more)
    hot = out.groupBy(F.col(name).alias("k")).agg(F.sum(size).alias("n")).where(F.col("n") > limit).select(
        "k", F.ceil(F.col("n") / batch_bytes).cast("int").alias(more))
    if not hot.head(1):
        return out, name, total
    out = out.join(F.broadcast(hot), F.col(name) == F.col("k"), "left").drop("k")
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(more)).cast("int")
    key = _batch_key(F.col(name)["cell"], F.col(name)["owner"], F.coalesce(deal, F.lit(0)))
    # rows may be alike in all columns, so they are dealt by position: written once, a rerun deals them alike
    return materialize(out.withColumn(name, key).drop(more)), name, total


def _batch_key(cell, owner, cut):
    return F.struct(cell.cast("long").alias("cell"), owner.cast("long").alias("owner"), cut.cast("int").alias("cut"))


def repeated(docs: DataFrame, doc_id: str, text: str, finish, schema: T.StructType | str, window: int = WINDOW,
             batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES, buckets: int | None = None,
             fan: int = FAN) -> DataFrame:
    """Run the passes; ``finish(passes, batch, gone, docs table)`` makes the rows of a batch.  Ids are not null."""
    dealt, name, total = batched(docs, doc_id, text, batch_bytes)
    buckets = buckets or max(1, min(BUCKETS, -(-total // bucket_bytes)), -(-total // LARGE_BUCKET))
    mail = Exchange((buckets - 1).bit_length(), -(-total // batch_bytes), fan)
    run = Passes(doc_id, text, window, mail.bits)
    by_batch = dealt.groupBy(name)                                # one shuffle of the texts serves every pass
    by_answer = lambda answers: by_batch.cogroup(answers.groupBy("batch"))

    def finished(key, left, right):
        docs_table = left.drop_columns([name])
        b, gone = run.removed(docs_table, right)
        return finish(run, b, gone, docs_table)

    sent = by_batch.applyInArrow(lambda key, docs: run.send_grams(key[0].as_py(), docs), MESSAGE)
    answers = mail.answered(sent, GRAM_FIELDS, sort_grams)
    sent = by_answer(answers).applyInArrow(
        lambda key, left, right: run.send_stretches(key[0].as_py(), left, right), MESSAGE)
    answers = mail.answered(sent, STRETCH_FIELDS, sort_stretches)
    sent = by_answer(answers).applyInArrow(
        lambda key, left, right: run.send_windows(key[0].as_py(), left, right), MESSAGE)
    answers = mail.answered(sent, WINDOW_FIELDS, sort_windows)
    return by_answer(answers).applyInArrow(finished, schema)


def _without_id(docs: DataFrame, doc_id: str) -> DataFrame | None:
    """The rows without an id, if there are any: they take no part in the passes."""
    rows = docs.where(F.col(doc_id).isNull())
    return rows if rows.head(1) else None


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, **sizes) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte spans)."""
    span = T.ArrayType(T.StructType().add("first", "long").add("end", "long"))
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType)]).add("n_bytes", "long").add(
        "n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("removed", span)

    def finish(run: Passes, b: Batch, gone: np.ndarray, table: pa.Table) -> pa.Table:
        spans = run.spans(b, gone)
        kept = []
        for lo, hi in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist()):
            kept.append(hashlib.sha256(b.data[lo:hi][~gone[lo:hi]].tobytes()).hexdigest())
        struct = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        return pa.table([table.column(doc_id), pa.array(np.diff(b.offsets)),
                         pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()),
                         pa.array([len(x) for x in spans], pa.int64()), pa.array(kept, pa.string()),
                         pa.array([[{"first": s, "end": e} for s, e in x] for x in spans], struct)],
                        names=schema.names)

    docs = docs.select(doc_id, text)
    out = repeated(docs.where(F.col(doc_id).isNotNull()), doc_id, text, finish, schema, window, **sizes)
    loose = _without_id(docs, doc_id)
    if loose is None:
        return out
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.lit(0).cast("long")
    return out.unionByName(loose.select(
        doc_id, F.octet_length(body).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2(body.cast("binary"), 256).alias("kept_sha256"), F.array().cast(span).alias("removed")))


def _kept_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The bytes that stay when only characters that are gone whole go."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)                  # the others are bytes inside a character
    whole = np.logical_and.reduceat(gone, lead) if len(lead) else np.zeros(0, bool)
    return ~np.repeat(whole, np.diff(np.concatenate((lead, [len(data)]))))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
                    window: int = WINDOW, **sizes) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the texts; same columns.

    A removed run that would cut a character keeps that character whole.  The
    column ``n_chars``, where there is one, is brought up to date."""
    schema = docs.schema

    def finish(run: Passes, b: Batch, gone: np.ndarray, table: pa.Table) -> pa.Table:
        keep = np.ones(len(b.data), bool)
        for lo, hi in row_blocks(b.offsets, SCAN_BYTES):          # characters never cross rows
            part = slice(int(b.offsets[lo]), int(b.offsets[hi]))
            keep[part] = _kept_characters(b.data[part], gone[part])
        old = table.column(text).to_pylist()
        texts = [None if o is None else b.data[lo:hi][keep[lo:hi]].tobytes().decode("utf-8", "replace")
                 for o, lo, hi in zip(old, b.offsets[:-1].tolist(), b.offsets[1:].tolist())]
        at = table.schema.get_field_index(text)
        table = table.set_column(at, text, pa.array(texts, table.schema.field(text).type))
        if n_chars in table.schema.names:
            at, kind = table.schema.get_field_index(n_chars), table.schema.field(n_chars).type
            count = [o if t is None else len(t) for o, t in zip(table.column(n_chars).to_pylist(), texts)]
            table = table.set_column(at, n_chars, pa.array(count, kind))
        return table

    out = repeated(docs.where(F.col(doc_id).isNotNull()), doc_id, text, finish, schema, window, **sizes)
    loose = _without_id(docs, doc_id)
    return out if loose is None else out.unionByName(loose)
