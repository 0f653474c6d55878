"""Ids of distinct words, remembered by a worker: each distinct word of a block is encoded once.

Known words lie in arrays sorted by 64-bit keys; their ids are one flat array.
The key of a word of up to seven bytes is those bytes and their number, so
equal keys are equal words.  The key of a longer one is a hash with its first
bit set, which no short word has, and a hash only proposes: the bytes of long
words are kept, every long word of a block is compared, byte by byte, with the
word whose ids it would get, and one that differs is encoded on its own.  The
memory is bounded: beyond ``limit`` words or ``LIMIT_BYTES`` of their bytes it
starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from hebdo.llm.bytescan import eights, same_bytes

LIMIT = 1_200_000               # words, about 50 bytes each
LIMIT_BYTES = 32 << 20
SHORT = 7                       # bytes of a word that is its own key
LONG = np.uint64(1 << 63)
KEEP = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], dtype=np.uint64)

#: (bytes, word starts, word ends) -> (flat ids, place of each word's ids in them, their number)
Encode = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


class WordMemory:
    def __init__(self, encode: Encode, limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)        # by key: the word's number
        self.at, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.begin, self.bytes = np.zeros(1, np.int64), np.zeros(0, np.uint8)        # of long words, by number

    def _learn(self, words, kinds: np.ndarray, example: np.ndarray) -> np.ndarray:
        """The number of each of the distinct keys ``kinds``; new words are encoded."""
        spot = np.searchsorted(self.known, kinds)
        new = np.ones(len(kinds), dtype=bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != kinds[inside]
        number = np.empty(len(kinds), dtype=np.int64)
        number[~new] = self.slot[spot[~new]]
        if new.any():
            at, spot = example[new], spot[new]
            flat, place, count = self.encode(words.data, words.start[at], words.end[at])
            number[new] = np.arange(len(at)) + len(self.slot)
            here = np.zeros(len(self.known) + len(at), dtype=bool)                   # places of the new keys
            here[spot + np.arange(len(at))] = True
            known, slot = np.empty(len(here), np.uint64), np.empty(len(here), np.int32)
            known[here], known[~here] = kinds[new], self.known
            slot[here], slot[~here] = number[new], self.slot
            self.known, self.slot = known, slot
            self.at = np.concatenate((self.at, place + len(self.flat)))
            self.size = np.concatenate((self.size, count.astype(np.int32)))
            self.flat = np.concatenate((self.flat, flat))
            length = words.end[at] - words.start[at]
            length[length <= SHORT] = 0
            ends = np.cumsum(length)
            self.begin = np.concatenate((self.begin, ends + len(self.bytes)))
            source = np.repeat(words.start[at] - (ends - length), length) + np.arange(int(ends[-1]))
            self.bytes = np.concatenate((self.bytes, words.data[source]))
        return number

    def rows(self, words, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, row offsets); with ``end_id`` every row ends with it.

        ``words`` has data, start, end, bounds and hashes(some), as ``bytescan.Words``."""
        if len(self.known) > self.limit or len(self.bytes) > LIMIT_BYTES:
            self._forget()
        length = words.end - words.start
        keys = eights(words.data)[words.start] & KEEP[np.minimum(length, SHORT)]
        keys |= length.astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(length > SHORT)
        keys[long] = words.hashes(long) | LONG
        order = np.argsort(keys)
        ranked = keys[order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
        kinds, example = ranked[first], order[first]
        number = self._learn(words, kinds, example)
        group = np.empty(len(keys), dtype=np.int64)
        group[order] = np.cumsum(first) - 1
        size, source, flat = self.size[number].astype(np.int64)[group], self.at[number][group], self.flat
        mine = number[group[long]]
        alone = long[~same_bytes(words.data, words.start[long], words.end[long],
                                 self.bytes, self.begin[mine], self.begin[mine + 1])]
        if len(alone):                                            # another word of the same hash
            more, at, count = self.encode(words.data, words.start[alone], words.end[alone])
            size[alone], source[alone] = count, at + len(flat)
            flat = np.concatenate((flat, more))
        total = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.repeat(source - total[:-1], size) + np.arange(int(total[-1]))]
        row_at = total[words.bounds]
        if end_id is None:
            return ids, row_at
        row_at = row_at + np.arange(len(row_at))
        out, word = np.empty(int(row_at[-1]), dtype=np.uint32), np.ones(int(row_at[-1]), dtype=bool)
        word[row_at[1:] - 1] = False
        out[word], out[~word] = ids, end_id
        return out, row_at
