"""Token-id files: Parquet with list columns, written in id order, read back selectively.

One file per range of ids.  The columns are ``doc_id``, ``n_tokens`` and
``ids`` (list of 32-bit integers); the ids use delta encoding (dictionary off,
format 2 pages) or a dictionary, row groups and pages have set sizes, and the
writer adds page indexes, so a reader of a few documents or of the metadata
columns alone skips the other pages.  Offsets of documents in the whole token
stream come from the metadata columns: token totals per file, a running sum
over the files, and a running sum inside each file.

Encoding calls the tokenizer library on distinct words.  All texts of a block
are cut at ASCII white space, which no token spans and every rule of the
tokenizer treats alike, and, in words of ASCII and Latin-1 characters, before
an ASCII mark that follows a letter or digit, where every token ends
(contractions begin with their mark).  Each distinct word is encoded once; a
worker remembers words up to a bound.  The encoded words travel to the library in texts of a few dozen, joined by a
NUL word, whose token marks the seams.

Cases: a null or empty text has only the end id; control strings of the
tokenizer inside a text are ordinary text, or with ``control_ids`` the control
ids that the untouched library gives (as written: other letter cases are
ordinary text); words with a NUL and very long
words are encoded on their own; equal ids keep all their rows, in the order
of their text; rows without an id come first; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.llm.bytescan import SPACE_WORDS, Words, text_blocks
from hebdo.llm.word_memory import WordMemory

END_ID = 2
BLOCK = 1 << 20
CALL_WORDS = 64                 # longer texts cost the library more a word
LONG_WORD = 256
FILE_BYTES = 32 << 20
#: Kinds of bytes, a bit each: the last of an ASCII or Latin-1 letter or a digit (0xC3 0x97 and 0xC3 0xB7 are
#: signs), an ASCII mark, A-Z, behind 0xC3 the second of a capital letter, and one of no ASCII or Latin-1 letter.
LETTER, MARK, CAPITAL, SECOND, OTHER = 1, 2, 4, 8, 16
KIND = bytes(
    LETTER * (chr(b).isalnum() if b < 0x80 else b < 0xC0 and b not in (0x97, 0xB7))
    + MARK * (0x20 < b < 0x7F and not chr(b).isalnum()) + CAPITAL * (0x41 <= b <= 0x5A)
    + SECOND * (0x80 <= b <= 0x9E and b != 0x97) + OTHER * (b >= 0x80 and b != 0xC3) for b in range(256))
_WORKER: dict[tuple[str, bool], WordEncoder] = {}


class WordEncoder:
    """The tokenizer and the words it has encoded so far."""

    def __init__(self, path: str, control_ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"            # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values() if control_ids else []
        if any(t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content] for t in added):
            raise ValueError("a control string reaches beyond its word")
        self.controls = [t.content.lower().encode() for t in added]
        self.tokenizer.encode_special_tokens = not control_ids
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        seam = self._encode(["a \x00 b"])[0]
        plain = self._encode(["a", "b", "a b"])
        self.seam = seam[len(plain[0])] if plain[0] + plain[1] == plain[2] and len(seam) == len(plain[2]) + 1 else None
        self.memory = WordMemory(self.encode_words)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, data: np.ndarray, start: np.ndarray,
                     end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, place of each word's ids in them, their number); many words to a library call."""
        at, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        nul = np.concatenate(([0], np.cumsum(data == 0)))
        simple = (end - start <= LONG_WORD) & (nul[end] == nul[start]) & (self.seam is not None)
        chosen, alone = np.flatnonzero(simple), [np.flatnonzero(~simple)]
        size = (end - start)[chosen]
        begin = np.concatenate(([0], np.cumsum(size + 3)))
        text = np.tile(np.array([0x20, 0, 0x20], dtype=np.uint8), int(begin[-1]) // 3 + 1)[:int(begin[-1])]
        for k in range(3):
            text[begin[1:] - 3 + k] = 0 if k == 1 else 0x20
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        text[np.repeat(begin[:-1], size) + within] = data[np.repeat(start[chosen], size) + within]
        raw = text.tobytes()
        groups = [(k, min(k + CALL_WORDS, len(chosen))) for k in range(0, len(chosen), CALL_WORDS)]
        flat, total = [], 0
        for (lo, hi), ids in zip(groups, self._encode([raw[begin[lo]:begin[hi] - 3].decode() for lo, hi in groups])):
            ids = np.array(ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.seam)
            if len(cuts) != hi - lo - 1:                          # a word holds the seam's token itself
                alone.append(chosen[lo:hi])
                continue
            edges = np.concatenate(([-1], cuts, [len(ids)]))
            at[chosen[lo:hi]], count[chosen[lo:hi]] = edges[:-1] + 1 + total, np.diff(edges) - 1
            flat.append(ids)
            total += len(ids)
        alone = np.concatenate(alone)
        words = [data[s:e].tobytes().decode() for s, e in zip(start[alone].tolist(), end[alone].tolist())]
        for i, ids in zip(alone.tolist(), self._encode(words) if words else []):
            at[i], count[i] = total, len(ids)
            flat.append(np.array(ids, dtype=np.uint32))
            total += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), at, count

    def encode_block(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, row offsets); every row ends with ``end_id``."""
        lowered, cuts = _lowered(data, self.controls)
        return self.memory.rows(Words(lowered, offsets, SPACE_WORDS, cuts), end_id)


def _lowered(data: np.ndarray, controls: Iterable[bytes] = ()) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with A-Z and capital Latin-1 letters in lower case, in words of nothing but
    ASCII and Latin-1 letters, and where such words are cut.  The tokenizer lower-cases and cuts
    there too, so fewer words are distinct; other words stay, because composition of marks comes
    before the lower case there, and so do words that hold one of ``controls`` in any letter
    case, which count as written."""
    raw = data.tobytes()
    kind = np.frombuffer(raw.translate(KIND), dtype=np.uint8)
    after, cuts = np.zeros((2, len(data)), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    cuts[1:] = (kind[1:] & MARK != 0) & (kind[:-1] & LETTER != 0)
    odd = (kind & OTHER != 0) & ~after
    folded = raw.lower() if controls else b""
    for c in controls:
        at = folded.find(c)
        while at >= 0:
            odd[at] = True
            at = folded.find(c, at + len(c))
    capital = (kind & CAPITAL != 0) | after & (kind & SECOND != 0)
    if odd.any():
        word = np.cumsum(~SPACE_WORDS[data])                      # bytes of one word share a number
        plain = np.ones(int(word[-1]) + 1, dtype=bool)
        plain[word[odd]] = False
        plain = plain[word]
        capital &= plain
        cuts &= plain
    return data + capital * np.uint8(0x20), cuts


def _encoder(path: str, control_ids: bool) -> WordEncoder:
    if (path, control_ids) not in _WORKER:
        _WORKER[path, control_ids] = WordEncoder(path, control_ids)
    return _WORKER[path, control_ids]


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
            end_id: int = END_ID, control_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row, row order and partitioning unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, control_ids)
        for b in batches:
            for lo, data, offsets in text_blocks(b.column("t"), BLOCK):
                ids, at = encoder.encode_block(data, offsets, end_id)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, len(at) - 1), pa.array(np.diff(at)), lists],
                    names=["doc_id", "n_tokens", "ids"])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids array<int>")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
                      end_id: int = END_ID, files: int | None = None, encoding: str = "delta",
                      row_group_bytes: int = 8 << 20, page_bytes: int = 256 << 10,
                      control_ids: bool = False) -> None:
    """Encode ``docs`` and write them in ascending id order, one file per id range.

    ``files`` defaults to one per ``FILE_BYTES`` of text; ``encoding`` is "delta" or "dictionary";
    ``control_ids`` leaves control strings to the library's default."""
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")
    if files is None:
        size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
        files = max(1, -(-int(size) // FILE_BYTES))
    ordered = docs.select(doc_id, text).repartitionByRange(files, doc_id).sortWithinPartitions(doc_id, text)
    (encoded(ordered, tokenizer, doc_id, text, end_id, control_ids).write.mode("error")
     .option("compression", "zstd")
     .option("parquet.writer.version", "v2" if encoding == "delta" else "v1")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .parquet(path))


def _place():
    """File and row number of each row of a token file."""
    return F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("nth")


def _starts(rows: DataFrame, path: str) -> DataFrame:
    """Adds ``start``: tokens of all documents before this one, in file and row order.

    The files' totals come from the token counts alone, whatever else ``rows`` reads."""
    earlier = Window.orderBy(F.length("file_name"), "file_name").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.sparkSession.read.parquet(path).select("n_tokens", _place()[0])
    totals = counts.groupBy("file_name").agg(F.sum("n_tokens").alias("file_tokens"))    # one row a file
    before = totals.select("file_name", F.coalesce(F.sum("file_tokens").over(earlier), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file_name").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("row_start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(before, "file_name").withColumn("start", F.col("file_start") + F.col("row_start"))


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start) of every document; reads the metadata columns only."""
    rows = spark.read.parquet(path).select("doc_id", "n_tokens", *_place())
    return _starts(rows, path).select("doc_id", "n_tokens", "start")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("ids")
            at = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(at).astype(np.int64)),
                                              b.column("file_name"), b.column("nth"), pa.array(crc, pa.int64())],
                                             names=["doc_id", "n_tokens", "file_name", "nth", "ids_crc32"])
    rows = spark.read.parquet(path).select("doc_id", "ids", *_place())
    rows = rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, file_name string, nth bigint, ids_crc32 bigint")
    return _starts(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")
