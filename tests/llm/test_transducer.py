"""The composed transducer: arcs, weights, and the least path against every path."""

import random

import public_tokenizers
import pytest
import sentencepiece

from hebdo.llm.sentencepiece_fst import META, Transducer

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def fst():
    return Transducer(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def every_path(fst, run, start=0, last=-1):
    """(weight, ids) of all accepted paths of the composition, by plain recursion."""
    if start == len(run):
        yield 0, []
        return
    for end, piece in fst.piece_arcs(run, start):
        if fst.follows(last, piece):
            for w, ids in every_path(fst, run, end, piece):
                yield w, [piece, *ids]
    weight, written = fst.fallback(run[start])
    for w, ids in every_path(fst, run, start + 1, -1):
        yield weight + w, written + ids


RUNS = [" the", " hello", " é", " x日", " \U0001d518a", " naïve", " aa", "\t", " 12a", " ☃b", "  a", " −1"]


@pytest.mark.parametrize("run", RUNS)
def test_the_least_of_all_paths_is_the_library_s_encoding(fst, library, run):
    paths = list(every_path(fst, run))
    least = min(w for w, _ in paths)
    best = [ids for w, ids in paths if w == least]
    assert len(paths) > 1 or run == "\t"                # fallback competes with pieces, where there are any
    assert best == [fst.shortest_path(run)] and fst.least_path(run) == (least, best[0])
    assert best[0] == library.encode(run[1:]) or not run.startswith(" ")


def test_weights_decide_between_competing_paths(fst):
    piece, = fst.shortest_path(" the")
    bytes_of = [fst.byte_ids[x] for x in (META + "the").encode()]
    weighed = {tuple(ids): w for w, ids in every_path(fst, " the")}
    assert weighed[(piece,)] == 0 and weighed[tuple(bytes_of)] == len(bytes_of) == 6
    # the same machine with fallback for nothing and dear pieces takes the bytes
    cheap = Transducer(PATH)
    cheap.fallback = lambda c, plain=cheap.fallback: (-1, plain(c)[1])
    weighed = {tuple(ids): w for w, ids in every_path(cheap, " the")}
    assert min(weighed, key=weighed.get) == tuple(bytes_of)


def test_a_queue_of_weighted_arcs_where_no_free_path_exists(fst):
    """Without the pieces that end a run the path must pay for bytes, as few as possible."""
    run = " thz"
    cut = Transducer(PATH)
    gone = {p for _, p in cut.piece_arcs(run, 3)} | {p for k in range(3) for e, p in cut.piece_arcs(run, k) if e == 4}
    cut.writes = [-1 if w in gone else w for w in cut.writes]
    weight, ids = cut.least_path(run)
    paths = list(every_path(cut, run))
    assert "z" in cut.single                             # so its bytes are not pushed out
    assert weight == min(w for w, _ in paths) == 1 and ids in [p for w, p in paths if w == weight]
    assert ids[-1] == fst.byte_ids[ord("z")]


def test_random_runs_equal_the_library(fst, library):
    rng = random.Random(1)
    alphabet = "aeiourstnlé  日𝔘ß☃-.'" + "the"
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 25))).replace("\n", "")
        ids = []
        runs, at = " " + text, 0
        for k in range(1, len(runs) + 1):                # runs begin at a space after a character
            if k == len(runs) or runs[k] == " " and runs[k - 1] != " ":
                ids += fst.shortest_path(runs[at:k])
                at = k
        assert ids == library.encode(text), text


def test_the_normaliser_is_composed_into_the_arcs(fst):
    assert fst.arcs[0][" "] == fst.arcs[0][META]
    assert fst.shortest_path(" the") == fst.shortest_path(META + "the")
    assert fst.fallback(" ")[1] == [fst.byte_ids[x] for x in META.encode()]
