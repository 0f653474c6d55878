"""Words cut before their marks: fewer calls of the library, the ids of whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hebdo.llm.bytescan import SPACE_WORDS, Words
from hebdo.llm.token_files import WordEncoder
from hebdo.llm.word_memory import WordMemory

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = list("abstvemldABSTZ019'''.,;:!?#&|<>-_(") + [
    "é", "É", "ß", "ÿ", "Þ", "×", "÷", "́", "̸", "é", "≠", "ж", "Σ", "ſ", "’", "中", " ", "　",
    "\x85", "\x00", "'s", "'LL", "n't", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "😀", "\x7f", "\xad"]


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))


def parts(ids, at):
    return [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])]


def test_a_word_is_encoded_once_whatever_marks_follow_it():
    encoder, seen = WordEncoder(PATH, True), []
    inner = encoder.encode_words
    encoder.memory.encode = lambda data, start, end: seen.append(len(start)) or inner(data, start, end)
    words = [f"{a}{b}{c}" for a in "kmnprst" for b in ("ao", "éo", "1e") for c in ("lin", "né")]
    texts = [" ".join(w + m for w in words) for m in ("", ",", ".", "!", ")", ";", "?", ":", "'s", "...", "***")]
    library = Tokenizer.from_file(PATH)
    got = [p for t in texts for p in parts(*encoder.encode_block(*buffer([t]), 2))]
    assert got == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert sum(seen) <= len(words) + len(texts)


@pytest.mark.parametrize("control_ids", [True, False])
def test_cut_words_have_the_ids_of_the_whole_text(control_ids):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS + [" ", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(6000)]
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = not control_ids
    encoder = WordEncoder(PATH, control_ids)
    got = [p for k in range(0, len(texts), 500) for p in parts(*encoder.encode_block(*buffer(texts[k:k + 500]), 2))]
    for text, ids in zip(texts, got):
        assert ids == library.encode(text, add_special_tokens=False).ids + [2], text


def test_short_words_are_told_apart_by_bytes_and_number():
    def encode(data, start, end):
        flat = np.concatenate([np.append(data[s:e], 0) for s, e in zip(start, end)]).astype(np.uint32)
        size = end - start + 1
        return flat, np.cumsum(size) - size, size
    words = ["é", "\x00a", "b" * 300] + [c * n + "\x00" * m for c in "ab\x7f" for n in range(10) for m in range(3)]
    words = [w for w in words if w]
    memory = WordMemory(encode)
    for texts in ([" ".join(words)], words, [" ".join(words[::-1]), "", words[3]], ["", ""], []):
        ids, at = memory.rows(Words(*buffer(texts), SPACE_WORDS))
        assert parts(ids, at) == [[x for w in t.split(" ") if w for x in [*w.encode(), 0]] for t in texts]
