"""License scans by ordered signature rules.

A text is read as its lower-cased words joined by single spaces.  A rule is a
regular expression over that string with a label, a priority and keywords; it
is tried only on texts that hold all its keywords (or a word that stands for
one).  Its detections are word intervals.  Detections are taken in the order
of priority (then length, then place); one that lies inside an interval
already taken is suppressed, and so is one that equals it.

The rules are written out in ``license_rules``: clauses of the licenses' own
texts, grants, titles, addresses, fields and identifiers.  An SPDX expression
gives one detection a term.  The keyword filter runs on word hashes of a whole
block at once; most texts never meet an expression.

Base phrases are counted at all their places, are never suppressed, and need
no rule.

Cases: a null or empty text has no words and no labels; repeated rows are
scanned one by one; other columns may be kept; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hebdo.llm.bytescan import ALNUM_WORDS, LOWER, Words, text_blocks, word_hash
from hebdo.llm.license_rules import EXPRESSIONS, RULES, SPDX, STEMS, expanded
from hebdo.llm.names import check_free

#: Phrases that are always counted, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

def keyword_words(keyword: str) -> tuple[str, ...]:
    """The words that stand for a keyword."""
    return STEMS.get(keyword, tuple(keyword.split("|")))


@dataclass(frozen=True)
class Rule:
    """``label`` is None for an SPDX expression: its terms give the labels."""
    label: str | None
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern

    def matches(self, text: bytes) -> Iterator[tuple[int, int, int, str]]:
        """(priority, first byte, end byte, label) of every place where the rule holds."""
        for m in self.pattern.finditer(text):
            if self.label is not None:
                yield self.priority, m.start(), m.end(), self.label
                continue
            first = m.start()                                     # the first term's interval holds the tag
            for term in _TERM.finditer(text, m.end("tag"), m.end()):
                yield self.priority, first if first >= 0 else term.start(), term.end(), SPDX[term.group().decode()]
                first = -1


def _whole(pattern: str) -> re.Pattern:
    """The pattern over whole words."""
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())


_TERMS = "|".join(sorted(SPDX, key=len, reverse=True))
_TERM = _whole(_TERMS)


def compile_rules() -> list[Rule]:
    """All rules, highest priority first."""
    out = [Rule(label, priority, keys, _whole(expanded(p))) for label, priority, keys, p in RULES]
    for priority, keys, tag, least in EXPRESSIONS:
        more = "{%d,}" % (least - 1)
        chain = f"(?P<tag>{expanded(tag)}) (?:{_TERMS})(?: (?:or|and|with) (?:{_TERMS})(?![^ ])){more}"
        out.append(Rule(None, priority, keys, _whole(chain)))
    return sorted(out, key=lambda r: -r.priority)


class _Reach:
    """Farthest end of the intervals taken so far that start at or before a place (prefix maxima)."""

    def __init__(self, starts: list[int]):
        self.at = {s: i + 1 for i, s in enumerate(starts)}
        self.tree = [-1] * (len(starts) + 1)

    def end_from(self, start: int) -> int:
        i, best = self.at[start], -1
        while i:
            best = max(best, self.tree[i])
            i &= i - 1
        return best

    def add(self, start: int, end: int) -> None:
        i = self.at[start]
        while i < len(self.tree):
            self.tree[i] = max(self.tree[i], end)
            i += i & -i


def suppressed(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """The detections that stand: by priority, then length, then place, those that lie in no interval taken before."""
    found = sorted(found, key=lambda d: (-d[0], d[1] - d[2], d[1], d[3]))
    kept, reach = [], _Reach(sorted({d[1] for d in found}))
    for d in found:
        if reach.end_from(d[1]) < d[2]:
            kept.append(d)
            reach.add(d[1], d[2])
    return kept


class Scanner:
    """Compiled rules, keyword table and base phrases."""

    def __init__(self):
        self.rules = compile_rules()
        words: dict[str, set[str]] = {}
        for r in self.rules:
            for k in r.keywords:
                words[k] = set(keyword_words(k))
        self.keywords = sorted(words)
        self.keyword_hashes = [np.array(sorted(word_hash(w) for w in words[k])) for k in self.keywords]
        table = np.unique(np.concatenate(self.keyword_hashes))
        self.gate = np.zeros(1 << 16, dtype=bool)
        self.gate[(table >> np.uint64(48)).astype(np.int64)] = True
        self.base = [(label, phrase.encode(), np.array([word_hash(w) for w in phrase.split()]))
                     for phrase, label in BASE_PHRASES.items()]
        self.needs = [frozenset(r.keywords) for r in self.rules]

    def _keywords_of(self, hashes: np.ndarray, rows: np.ndarray) -> dict[int, set[str]]:
        """Keywords of each row that has any."""
        maybe = np.flatnonzero(self.gate[(hashes >> np.uint64(48)).astype(np.int64)])
        out: dict[int, set[str]] = {}
        for k, known in zip(self.keywords, self.keyword_hashes):
            for row in np.unique(rows[maybe[np.isin(hashes[maybe], known)]]).tolist():
                out.setdefault(row, set()).add(k)
        return out

    def detections(self, text: bytes, keywords: set[str]) -> list[tuple[int, int, int, str]]:
        """(priority, first byte, end byte, label) of the rules that hold after suppression."""
        found = []
        for rule, needs in zip(self.rules, self.needs):
            if needs <= keywords:
                found += rule.matches(text)
        return suppressed(found)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[dict]:
        """One result a row of a block."""
        words = Words(LOWER[data], offsets, ALNUM_WORDS)
        hashes, rows, counts = words.hashes(), words.rows(), words.counts()
        out = [{"n_words": int(n), "places": [], "found": []} for n in counts]
        for label, raw, phrase in self.base:
            size = len(phrase)
            if len(hashes) >= size:
                hit = rows[:len(rows) - size + 1] == rows[size - 1:]
                for i in range(size):
                    hit &= hashes[i:len(hashes) - size + 1 + i] == phrase[i]
                for at in np.flatnonzero(hit).tolist():
                    said = b" ".join(words.data[s:e].tobytes() for s, e in
                                     zip(words.start[at:at + size].tolist(), words.end[at:at + size].tolist()))
                    if said == raw:
                        r = int(rows[at])
                        out[r]["places"].append((at - int(words.bounds[r]), label))
        for r, keywords in self._keywords_of(hashes, rows).items():
            if not any(needs <= keywords for needs in self.needs):
                continue
            lo, hi = int(words.bounds[r]), int(words.bounds[r + 1])
            parts = [words.data[s:e].tobytes() for s, e in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist())]
            begin = np.cumsum([0] + [len(p) + 1 for p in parts])
            for priority, s, e, label in self.detections(b" ".join(parts), keywords):
                first = int(np.searchsorted(begin, s, side="right")) - 1
                end = int(np.searchsorted(begin, e, side="left"))
                out[r]["found"].append({"label": label, "priority": priority, "first": first, "end": end})
        return out


def score(found: list[dict], base: set[str]) -> float:
    """Confidence that the text states a license: one minus the product of the misses."""
    miss = 0.1 if base else 1.0
    for label, priority in {(d["label"], d["priority"]) for d in found}:
        miss *= 1.0 - priority / 100.0
    return round(1.0 - miss, 6)


_WORKER: list[Scanner] = []
NAMES_MADE = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
RESULT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, " \
         "score double, detections array<struct<label:string,priority:int,first:int,end:int>>"


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and per row: word count, base places, labels, score and the detections (word intervals)."""
    check_free(keep, NAMES_MADE)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _WORKER:
            _WORKER.append(Scanner())
        for b in batches:
            got = [x for _, data, offsets in text_blocks(b.column(text)) for x in _WORKER[0].scan(data, offsets)]
            places = [sorted(x["places"]) for x in got]
            base = [{label for _, label in p} for p in places]
            labels = [s | {d["label"] for d in x["found"]} for s, x in zip(base, got)]
            detection = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first", pa.int32()),
                                            ("end", pa.int32())]))
            columns = [pa.array([x["n_words"] for x in got], pa.int64()),
                       pa.array([len(p) for p in places], pa.int64()),
                       pa.array([p[0][0] if p else None for p in places], pa.int64()),
                       pa.array([p[-1][0] if p else None for p in places], pa.int64()),
                       pa.array([",".join(sorted(s)) for s in base], pa.string()),
                       pa.array([",".join(sorted(s)) for s in labels], pa.string()),
                       pa.array([score(x["found"], s) for x, s in zip(got, base)], pa.float64()),
                       pa.array([x["found"] for x in got], detection)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + columns, names=[*keep, *NAMES_MADE])
    return docs.mapInArrow(run, f"{fields}, {RESULT}")
