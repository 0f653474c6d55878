"""Words whose hashes meet keep their own ids, in a block and across blocks."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hebdo.llm import word_memory
from hebdo.llm.bytescan import SPACE_WORDS, Words
from hebdo.llm.sentencepiece_fst import Transducer
from hebdo.llm.token_files import WordEncoder


def twins(size):
    """The Thue-Morse word over a and b and its complement: equal polynomial hashes from 1,024 letters on."""
    a, b = "a", "b"
    while len(a) < size:
        a, b = a + b, b + a
    return a, b


def buffer(texts):
    raw = "".join(texts).encode()
    return np.frombuffer(raw, dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))


def parts(ids, at):
    return [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])]


def test_the_hashes_do_meet():
    a, b = twins(1024)
    data, offsets = buffer([a + " ", b])
    assert len(set(Words(data, offsets, SPACE_WORDS).hashes().tolist())) == 1


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
@pytest.mark.parametrize("together", [True, False])
def test_both_tokenizers_tell_them_apart(size, together):
    a, b = twins(size)
    texts = [f"x {a} y {b} {a}", b, a, f"{b} {b} x"]
    blocks = [texts] if together else [[t] for t in texts]
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = WordEncoder(path, True), Tokenizer.from_file(path)
    got = [p for block in blocks for p in parts(*words.encode_block(*buffer(block), 2))]
    assert got == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    path = public_tokenizers.path("piece_bpe_32k.model")
    fst, sp = Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    got = [p for block in blocks for p in parts(*fst.encode_block(*buffer(block)))]
    assert got == [sp.encode(t) for t in texts]


def test_the_memory_starts_anew_beyond_its_bytes(monkeypatch):
    monkeypatch.setattr(word_memory, "LIMIT_BYTES", 50)
    seen = []

    def encode(data, start, end):
        seen.append(len(start))
        size = end - start
        return size.astype(np.uint32), np.arange(len(start)), np.ones(len(start), np.int64)
    memory = word_memory.WordMemory(encode)
    for _ in range(4):
        data, offsets = buffer(["one three fifteen " * 4, "", "a" * 60])
        ids, at = memory.rows(Words(data, offsets, SPACE_WORDS), 7)
        assert parts(ids, at) == [[3, 5, 7] * 4 + [7], [7], [60, 7]]
    assert seen == [4, 4, 4, 4]
