"""Operators on documents against brute force, with the edge cases of their docstrings."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hebdo.llm import (decontaminate, licenses, quality, rules, sentencepiece_fst, simhash, suffix_dedup, token_files,
                       toxicity)
from hebdo.llm.catalog import fold
from tests.llm import brute

ODD = [None, "", " ", "\n\n", "a", "A b", "x" * 5000, "Ähre É é ́x  ΣΑΣ.", "日本語 テスト", "don't 12345 ...!!",
       "a\tb\nc\r\nd", "<|endoftext|> <s> </s> <unk>", "x \x00 y", "  two  blanks ", "H̱ À×Þ µ ŸŒ", "a▁b",
       "a\u0085b\x1cc", "\t\ttab", "=" * 70, "    " * 20 + "x", "𝔘𝔫𝔦 मानक हिन्दी"]
WORDS = "alpha Beta gamma delta, eps zeta. eta theta iota kappa lamda mu".split()


def texts(seed, n, longest=60, words=WORDS):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, longest))) for _ in range(n)]


CLASHES = ["batch_no", "batch_cuts", "id", "fp", "keeper", "least_row", "quality_score", "benchmark_state", "bucket",
           "kept", "w", "y", "component", "batch", "kind", "body"]


def frame(spark, rows):
    """Rows of (id, text) with columns whose names operators use inside."""
    schema = "doc_id bigint, text string, extra string, t string, " + ", ".join(f"{c} int" for c in CLASHES)
    return spark.createDataFrame([(i, t, "e", "clash", *[7] * len(CLASHES)) for i, t in rows], schema).repartition(3)


def empty(spark):
    return frame(spark, [])


def test_decontamination_matches_brute_force(spark):
    items = [(0, " ".join(WORDS)), (1, "alpha beta"), (2, None), (3, "…"), (4, "ALPHA, Beta! gamma"), (10, "mu mu"),
             (11, " ".join(WORDS[::-1] * 2))]
    docs = [(i, t) for i, t in enumerate(ODD + texts(3, 60) + [" ".join(WORDS * 300)] + ["alpha beta"] * 2)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (1 << 20, 40):                          # one pass, and several passes over the items
        hits = decontaminate.benchmark_hits(frame(spark, docs), bench, keep=["doc_id", "extra"], state="found",
                                            item_block_bytes=size)
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"])
               for r in decontaminate.hit_digest(hits, ["doc_id"], "found").collect()}
        assert [got[i] for i, _ in docs] == brute.decontamination([t for _, t in docs], items)
    clean = decontaminate.decontaminate(frame(spark, docs), bench)
    assert clean.columns == frame(spark, docs).columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in docs if not got[i][1]}
    none = decontaminate.benchmark_hits(empty(spark), bench, state="found")
    assert decontaminate.hit_digest(none, ["doc_id"], "found").count() == 0
    with pytest.raises(ValueError):                    # a column of the caller's has the state's name
        decontaminate.benchmark_hits(empty(spark), bench)
    assert decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).count() == len(docs)


def test_simhash_matches_brute_force(spark):
    rng = random.Random(9)
    base = texts(4, 12, 200)
    near = [" ".join(w if rng.random() > 0.01 else "changed" for w in b.split()) for b in base for _ in range(4)]
    rows = list(enumerate(ODD + base + near + [base[0]] * 20)) + [(3, "rows of one id"), (3, base[2]), (7, base[1])]
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = [(i, brute.simhash(t)) for i, t in rows]
    assert sorted((r["id"], r["fp"] & (1 << 64) - 1) for r in found) == sorted(prints)
    want = brute.simhash_groups(prints)
    assert {r["id"]: r["component"] for r in found} == want
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0
    gone = frame(spark, [(1, "a b c")]).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r["component"] for r in simhash.near_duplicates(gone).collect()] == [None]


def test_simhash_cuts_large_tiles(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 2))) & (1 << 64) - 1 for s in seeds
              for _ in range(20)}
    rows = [(i, f) for i, f in enumerate(sorted(prints))]
    classes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in rows], "fp bigint, id bigint")
    want = brute.simhash_groups(rows)
    for tile in (4096, 3):
        found = simhash.components(simhash.links(classes, tile=tile), "a", "b")
        got = {r["node"]: r["component"] for r in found.collect()}
        assert {i: got.get(i, i) for i, _ in rows} == want


def test_suffix_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    mixed = [rng.choice([None, "", "x" * 500, "ab" * rng.randint(1, 200), base[rng.randrange(60)],
                         base[rng.randrange(60)][:100] + base[rng.randrange(60)][30:] + base[rng.randrange(60)]])
             for _ in range(90)]
    rows = [(i ** 3 if i > 30 else i, t) for i, t in enumerate(mixed + ODD)]
    rows += rows[:5] + [(4, "y" * 120), (10 ** 12, "y" * 130)]
    for window, batch, bucket in ((50, 1500, 4000), (30, 1 << 20, 1 << 20)):
        got = suffix_dedup.digest(frame(spark, rows), window=window, batch_bytes=batch, bucket_bytes=bucket).collect()
        keys = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sorted(tuple(r[k] for k in keys) for r in got) == sorted(brute.suffix_dedup(rows, window))
        assert all(sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"] for r in got)
    assert suffix_dedup.digest(empty(spark)).count() == 0


def test_suffix_dedup_texts_keep_whole_characters(spark):
    shared = "ü" * 40 + "passage that two documents share, and it is long enough"
    rows = [(1, "one " + shared), (2, shared + " two"), (3, None), (4, "é" + shared[1:])]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("int"))
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == " two" and got[3]["text"] is None
    assert got[4]["text"] == "é" and got[2]["n_chars"] == 4 and got[3]["n_chars"] is None
    null_id = docs.withColumn("doc_id", F.when(F.col("doc_id") > 1, F.col("doc_id")))
    assert sorted(len(r["text"] or "") for r in suffix_dedup.without_repeats(null_id).collect()) == [
        0, 1, len(rows[0][1]), len(rows[1][1])]


def test_rule_ledger_matches_brute_force(spark):
    docs = list(enumerate(ODD + texts(1, 40) + [" ".join(["rep eat"] * 300), "# # $ %% line\n" * 40, "s\n\ns\n s\ns"]))
    rows = {r["doc_id"]: r for r in rules.ledger(frame(spark, docs), ["doc_id", "extra", "t"]).collect()}
    for i, t in docs:
        r = rows[i]
        want = brute.rule_measures(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert bool(r["failed_bits"] & 1) == (want[0] < 20)
        assert bool(r["failed_bits"] & 2) == (100 * want[4] > 30 * want[0])
        assert r["t"] == "clash"
    assert rules.ledger(empty(spark), ["doc_id"]).count() == 0


def test_rule_ablations_count_what_each_rule_does(spark):
    bits = [0, 1, 1, 2, 3, 4, 6, 0]
    df = spark.createDataFrame([(b,) for b in bits], "failed_bits bigint")
    got = {(r["policy"], r["version"], r["rule"]): r for r in rules.ablations(df).collect()}
    for p in rules.POLICIES:
        for k in p.bits:
            r = got[p.name, p.version, rules.RULES[k][0]]
            inside = [b & p.mask for b in bits]
            assert r["rejected"] == sum(b != 0 for b in inside)
            assert r["failed"] == sum(bool(b >> k & 1) for b in bits)
            assert r["only"] == sum(b == 1 << k for b in inside)
            assert r["kept_without"] == sum(b & ~(1 << k) == 0 for b in inside)


def test_license_scan_counts_base_phrases_and_suppresses(spark):
    docs = list(enumerate(ODD + [
        "Licensed under the MIT License. under the mit, license under the mit license",
        "CC-BY-NC 4.0, and licensed under CC BY-NC-SA; Apache License, Version 2.0",
        "SPDX-License-Identifier: GPL-3.0-only. All rights reserved.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
        "mit der Zeit", " ".join(["under the mit license"] * 400)] + texts(2, 20)))
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, docs), ["doc_id"]).collect()}
    for i, t in docs:
        w = brute.words(t)
        at = [(k, label) for p, label in licenses.BASE_PHRASES.items() for k in range(len(w))
              if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        base = {label for _, label in at}
        assert r["base_labels"] == ",".join(sorted(base)) and base <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        inside = [(a, b) for a in r["detections"] for b in r["detections"] if a != b]
        assert not any(a["first"] == b["first"] and a["end"] == b["end"] for a, b in inside)
        assert not any(b["priority"] > a["priority"] and b["first"] <= a["first"] and a["end"] <= b["end"]
                       for a, b in inside)
    k = len(ODD)
    assert got[k]["labels"] == "mit" and got[k + 4]["labels"] == "" and got[k + 3]["labels"] == "mit"
    assert "gpl-3" in got[k + 2]["labels"] and "all-rights-reserved" in got[k + 2]["labels"]
    assert got[k + 1]["labels"].split(",") == ["apache-2", "cc-by-nc", "cc-by-nc-sa"]
    assert licenses.scan(empty(spark), ["doc_id"]).count() == 0
    assert len(licenses.compile_rules()) > 200


def test_token_files_equal_whole_text_encoding(spark, tmp_path):
    name = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(name)
    t.encode_special_tokens = True
    rows = list(enumerate(ODD + texts(8, 30) + ["wörter " * 900]))
    rng = random.Random(0)
    rng.shuffle(rows)
    for encoding in ("delta", "dictionary"):
        path = str(tmp_path / encoding)
        token_files.write_token_files(frame(spark, rows), path, name, files=4, encoding=encoding)
        got = {r["doc_id"]: r for r in token_files.read_digest(spark, path).collect()}
        offsets = {r["doc_id"]: r for r in token_files.read_offsets(spark, path).collect()}
        start = 0
        for i, x in sorted(rows):
            ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], dtype="<u4")
            assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (
                start, len(ids), zlib.crc32(ids.tobytes())), x
            assert (offsets[i]["start"], offsets[i]["n_tokens"]) == (start, len(ids))
            start += len(ids)
    plan = token_files.read_offsets(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema", 1)[1].split(">")[0]
    path = str(tmp_path / "none")
    token_files.write_token_files(empty(spark), path, name)
    assert token_files.read_digest(spark, path).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(empty(spark), path, name, encoding="plain")


def test_transducer_equals_the_library_and_round_trips(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = list(enumerate(ODD + texts(8, 30) + ["long text " * 3000, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa bbbbbb"]))
    out = sentencepiece_fst.encode_and_check(frame(spark, rows), path, ["doc_id", "text", "t"])
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in rows:
        assert list(got[i]["piece_ids"]) == sp.encode(t or ""), t
        assert got[i]["n_ids"] == len(got[i]["piece_ids"]) and got[i]["round_trip"]
    back = sentencepiece_fst.decode(sentencepiece_fst.encode(frame(spark, rows), path, ["doc_id"]), path, ["doc_id"])
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t in rows}
    assert sentencepiece_fst.encode_and_check(empty(spark), path, ["doc_id"]).count() == 0


def shortest_by_weight(fst, run):
    """Brute force over all segmentations: the valid chains of pieces, least byte weight first."""
    best = []

    def walk(i, last, ids, weight):
        if i == len(run):
            best.append((weight, ids))
            return
        for j in range(i + 1, len(run) + 1):
            p = fst.ids.get(run[i:j])
            if p is not None and fst.history(p) is not None and (last < 0 or fst.seam(last, p)):
                walk(j, p, ids + [p], weight)
        if run[i] not in fst.ids:
            raw = run[i].encode()
            walk(i + 1, -1, ids + [fst.byte_ids[b] for b in raw], weight + len(raw))
    walk(0, -1, [], 0)
    return sorted(best)


def test_transducer_path_is_the_shortest_of_all():
    fst = sentencepiece_fst.Transducer(public_tokenizers.path("piece_bpe_32k.model"))
    for run in ("▁the", "▁hello", "▁aaaa", "ab\nc", "▁x𝔘y", "▁▁▁z", "▁unitin"):
        every = shortest_by_weight(fst, run)
        assert len(every) == 1 and every[0][1] == fst.shortest_path(run)


def labelled(spark, bad, seed, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(30, 90))]
        y = i % 3 == 0
        if y:
            bad(words, rng)
        rows.append((i, " ".join(words), int(y)))
    labels = spark.createDataFrame([(i, 1 - y, y) for i, _, y in rows] + [(0, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    return rows, labels


def test_quality_held_out_accuracy_and_cases(spark):
    def junk(words, rng):
        words[5:] = [words[0].upper() + "!!" if rng.random() < 0.5 else words[1]] * (len(words) - 5)
    rows, labels = labelled(spark, junk, 1)
    docs = frame(spark, [(i, t) for i, t, _ in rows])
    model = quality.learn(docs, labels, fold("id", 5) != 0)
    got = {r["doc_id"]: r["quality_score"] for r in quality.with_scores(docs, model, ["doc_id"]).collect()}
    held = [(got[i] >= quality.CUT) == (y == 0) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(held) >= 0.95
    odd = quality.with_scores(frame(spark, list(enumerate(ODD))), model, ["doc_id", "extra"])
    assert all(0 <= r["quality_score"] <= 1 for r in odd.collect())
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s >= quality.CUT for s in got.values())
    blind = quality.learn(docs, labels.where("quality = 1"), fold("id", 5) != 0)
    assert {r["quality_score"] for r in quality.with_scores(docs, blind, ["doc_id"]).collect()} == {1.0}
    assert quality.with_scores(empty(spark), quality.learn(empty(spark), labels, fold("id", 5) != 0),
                               ["doc_id"]).count() == 0


def test_toxicity_held_out_accuracy_and_misspellings(spark):
    def insult(words, rng):
        for _ in range(4):
            words[rng.randrange(len(words))] = rng.choice(["worthless", "disgusting", "pathetic"])
    rows, labels = labelled(spark, insult, 2, 360)
    more = [(1000, "alpha beta gamma wortthless eta theta " + " ".join(WORDS * 3)), (1001, " ".join(WORDS * 9))]
    docs = frame(spark, [(i, t) for i, t, _ in rows] + more)
    model = toxicity.learn(docs, labels, fold("id", 4) != 2, bags_seen=20_000)
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.with_scores(docs, model, ["doc_id"]).collect()}
    held = [(got[i] >= toxicity.CUT) == (y == 1) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean(held) >= 0.95
    assert got[1000] > got[1001]                       # a misspelling that was never seen
    odd = toxicity.with_scores(frame(spark, list(enumerate(ODD))), model, ["doc_id", "extra"])
    assert all(0 <= r["toxic_score"] <= 1 for r in odd.collect())
    blind = toxicity.learn(docs, labels.where("toxic = 0"), fold("id", 4) != 2)
    assert {r["toxic_score"] for r in toxicity.with_scores(docs, blind, ["doc_id"]).collect()} == {0.0}
    assert toxicity.with_scores(empty(spark), model, ["doc_id"]).count() == 0
