"""Inputs named by the second review: the whole job on texts, names and ids the given tables do not hold."""

import itertools
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hebdo.llm import decontaminate, licenses, toxicity
from hebdo.llm.bytescan import ALNUM_WORDS, word_texts
from hebdo.llm.catalog import QUERIES, fold
from tests.llm import brute
from tests.llm.test_documents import ODD, WORDS, frame, labelled, texts


def test_toxicity_sample_holds_very_long_texts_whole(spark):
    def insult(words, rng):
        for _ in range(4):
            words[rng.randrange(len(words))] = rng.choice(["worthless", "disgusting", "pathetic"])
    rows, labels = labelled(spark, insult, 2, 240)
    first = {y: min((i for i, _, k in rows if k == y and i), key=lambda i: (i * 2654435761) & 0xFFFFFFFF)
             for y in (0, 1)}                              # the first text of each class in the sample's order
    rows = [(i, t if i not in first.values() else (t + " ") * 400, y) for i, t, y in rows]
    assert all(len(t) > 60_000 for i, t, _ in rows if i in first.values())
    docs = frame(spark, [(i, t) for i, t, _ in rows])
    model = toxicity.learn(docs, labels, fold("id", 4) >= 0, bags_seen=20_000)
    got = {r["doc_id"]: r["toxic_score"] for r in toxicity.with_scores(docs, model, ["doc_id"]).collect()}
    right = [(got[i] >= toxicity.CUT) == (y == 1) for i, _, y in rows]
    assert sum(right) >= 0.95 * len(right)


def test_toxicity_bags_hold_every_word(spark):
    long = " ".join(WORDS * 4000)
    rows = [(1, 0, long), (2, 1, "A b-c " * 5), (3, 1, None), (4, 0, "?!"), (5, 1, "x")]
    bags = toxicity.bags_of(spark.createDataFrame(rows, "id bigint, y int, t string")).collect()
    by_id = {i: sorted((b["bag"], bytes(b["words"])) for b in bags if b["id"] == i) for i, _, _ in rows}
    for i, y, t in rows:
        words = word_texts(t, ALNUM_WORDS)
        n = toxicity.SEGMENT
        assert by_id[i] == [(k // n, b" ".join(words[k:k + n])) for k in range(0, len(words), n)]
    assert {(b["id"], b["y"]) for b in bags} == {(1, 0), (2, 1), (5, 1)}


def test_toxicity_stream_holds_every_bag_once_a_pass(spark):
    rows = [(i, i % 2, t) for i, t in enumerate(texts(9, 90, 80))]
    bags = toxicity.bags_of(spark.createDataFrame(rows, "id bigint, y int, t string")).repartition(3).cache()
    n = bags.count()
    seen = [[(r["id"], bytes(r["words"])) for r in toxicity._stream(bags, 3, s).collect()] for s in (1, 2)]
    for stream in seen:
        passes = [stream[k * n:(k + 1) * n] for k in range(3)]
        assert len(stream) == 3 * n and passes[0] != passes[1]
        assert sorted(passes[0]) == sorted(passes[1]) == sorted(passes[2])
    assert seen[0] != seen[1]
    batch = pa.RecordBatch.from_pydict({"k": list(range(1300))})
    parts = list(toxicity._sliced(iter([batch.slice(0, 700), batch.slice(700, 0), batch.slice(700)])))
    assert [p.num_rows for p in parts] == [toxicity.BATCH] * 2 + [1300 - 2 * toxicity.BATCH]
    assert [k for p in parts for k in p.column("k").to_pylist()] == list(range(1300))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables not present")
def test_op8_finds_nine_of_ten_held_out_toxic_documents(spark):
    d = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r["predicted"]) for r in
           QUERIES["op8_toxicity_subword_bags"](spark, d).where("held_out").collect() if r["doc_id"] in labels]
    caught, toxic, flagged = sum(y and p for y, p in got), sum(y for y, _ in got), sum(p for _, p in got)
    assert toxic >= 100 and caught >= 0.9 * toxic and caught >= 0.8 * flagged


def test_op9_control_strings_as_in_the_untouched_library(spark, tmp_path):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = list(enumerate(ODD + [
        "a <|endoftext|> b", "A<|startoftext|>B<|endoftext|><|endoftext|>c", "<|ENDOFTEXT|> <|EndOfText|>É X",
        "x<|endoftext|>\x00y", "\x00<|startoftext|>", "Ü" * 400 + "<|endoftext|>" + "Z" * 400, "<|endoftext|",
        "É<|endoftext|>É\u0301 Q", "<|endoftext|>"]))
    folder = str(tmp_path / "sf")
    frame(spark, rows).select("doc_id", "text").write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op9_token_id_files"](spark, folder).collect()}
    start = 0
    for i, x in rows:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids)), x
        start += len(ids)


def spelled(tree):
    """Strings of a parsed expression: every branch, options with and without, sets by each first letter."""
    parts = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "NOT_LITERAL":
            parts.append(["x"])
        elif name == "IN":
            parts.append([chr(v if str(o) == "LITERAL" else v[0]) for o, v in arg])
        elif name == "BRANCH":
            parts.append([x for branch in arg[1] for x in spelled(branch)])
        elif name == "SUBPATTERN":
            parts.append(spelled(arg[3]))
        elif name == "MAX_REPEAT":
            once = spelled(arg[2])
            parts.append(([""] if arg[0] == 0 else []) + once)
        else:
            assert name == "ASSERT_NOT", name
    return ["".join(x) for x in itertools.product(*parts)]


def spellings(pattern):
    return spelled(re._parser.parse(pattern))


def implied(pattern, keyword):
    return all(set(licenses.keyword_words(keyword)) & set(x.split()) for x in spellings(pattern))


def test_license_keywords_are_in_every_alternative_of_their_pattern():
    for label, _, keys, pattern in licenses.RULES:
        assert keys
        # long optional parts are the same for all rules: their alternatives hold no keyword but "under"
        short = pattern.replace("{of}", "").replace("{c}", "").replace("{p}", "").replace("{v}", "").replace("{o}", "")
        for k in keys:
            assert implied(licenses.expanded(short), k), (label, k, pattern)


GNU = "you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by " \
      "the Free Software Foundation, either version {} of the License, or (at your option) any later version."


@pytest.mark.parametrize("text,label", [
    ("Licensed under the Open Software License 3.0", "osl"),
    ("Released under the Zero-Clause BSD license", "0bsd"),
    (GNU.format("", 3), "gpl-3"), (GNU.format("", 2), "gpl-2"), (GNU.format("Lesser", 2.1), "lgpl-2"),
    (GNU.format("Affero", 3), "agpl-3"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "cc-by-nc-sa"),
    ("Creative Commons Attribution-NoDerivatives 4.0 International", "cc-by-nd"),
    ("licensed under a Creative Commons license", "cc"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "gpl-3"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "lgpl-2"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3", "agpl-3"),
    ("Apache License\nVersion 2.0, January 2004", "apache-2"), ("Mozilla Public License Version 2.0", "mpl-2"),
    ("Eclipse Public License - v 2.0", "epl"), ("Boost Software License - Version 1.0", "boost"),
    ("CC0 1.0 Universal", "cc0"), ("Released under the GPL", "gpl"), ("under the GNU LGPL", "lgpl"),
    ("under the Apache License", "apache"), ("under a BSD-style license", "bsd"), ("under an MIT license", "mit"),
    ("under an Apache v2 license", "apache-2"), ("License: GPLv2+", "gpl-2"), ("License: LGPLv2.1", "lgpl-2"),
    ("licensed under the AGPLv3", "agpl-3"), ("MPLv2 license", "mpl-2"),
    ("Do What The Heck You Want To Public License", "wtfpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
])
def test_license_rules_know_names_headers_and_titles(text, label):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    found = licenses.Scanner().scan(data, np.array([0, len(data)]))[0]["found"]
    assert {d["label"] for d in found} == {label}


@pytest.mark.parametrize("text", ["the Apache 2 server got a boost", "open software for the general public",
                                  "the library is under a tree", "mit der Zeit", "new software licenses"])
def test_license_rules_leave_other_texts_alone(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    assert licenses.Scanner().scan(data, np.array([0, len(data)]))[0]["found"] == []


def test_near_duplicate_stage_goes_by_texts_not_ids(spark):
    base = texts(21, 14, 200)
    base = [b + " " + " ".join(f"w{i}x{k}" for k in range(40)) for i, b in enumerate(base)]
    near = [b + " changed" for b in base[:6]]
    rows = [(None, base[0]), (None, near[0]), (None, base[1]), (5, near[1]), (7, base[2]), (7, base[3]), (8, near[2]),
            (9, near[3]), (7, base[4]), (7, near[4]), (3, near[4]), (None, base[5]), (None, base[5]), (6, base[6]),
            (6, base[6]), (None, None), (None, ""), (11, base[7]), (12, base[8]), (None, base[9]), (2, base[9]),
            (2, base[10])]
    prints = [brute.simhash(t) for _, t in rows]
    groups = brute.simhash_groups(list(enumerate(prints)))          # by row: unique ids
    want = []
    for g in set(groups.values()):
        mine = [rows[k] for k in groups if groups[k] == g]
        want.append(min(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")))
    docs = frame(spark, rows)
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and len(want) > 10
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=order) == sorted(want, key=order)
    unique = frame(spark, list(enumerate(base + near)))
    assert stage(spark, unique, "").count() == len(set(brute.simhash_groups(
        [(i, brute.simhash(t)) for i, t in enumerate(base + near)]).values()))
    assert stage(spark, docs.limit(0), "").count() == 0


def test_decontamination_searches_items_without_an_id(spark):
    lost, empty, named = ("null one two three four five", "void six seven eight", "named nine ten")
    bench = spark.createDataFrame([(None, lost), ("", empty), ("a", named)], "item_id string, text string")
    docs = frame(spark, [(0, "x " + lost), (1, empty + " y"), (2, f"{lost} {empty} {named}"), (3, "clean"), (4, named)])
    docs = docs.select("doc_id", "text")
    for limit in (1 << 20, 20):
        hits = decontaminate.benchmark_hits(docs, bench, item_block_bytes=limit)
        got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.hit_digest(hits, ["doc_id"]).collect()}
        assert got == {0: (6, [None]), 1: (4, [""]), 2: (13, ["", "a", None]), 3: (0, []), 4: (3, ["a"])}
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == [3]
