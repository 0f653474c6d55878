"""Registered queries: SQL oracles at sf0.001, contracts of the others, the pipeline's stages."""

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from hebdo.llm import licenses
from hebdo.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm import brute
from tests.test_entry import SF, canon

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(columns, want.fetchall())


@pytest.mark.parametrize("name", ["op3_chat_budgeted_windows", "op6_quality_rule_ledger"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name,columns", [
    ("op1_quality_bradley_terry", {"doc_id", "held_out", "score", "predicted"}),
    ("op8_toxicity_subword_bags", {"doc_id", "held_out", "score", "predicted"}),
    ("op7_simhash_near_dedup", {"doc_id", "fingerprint", "component_id"}),
])
def test_one_row_a_document(spark, name, columns):
    df = QUERIES[name](spark, SF)
    assert columns <= set(df.columns)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_equals_its_stages_on_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert docs.columns == columns
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    whole = corpus_pipeline.run(spark, SF)
    key = lambda r: (r["doc_id"], r["n_ids"], list(r["piece_ids"]), r["round_trip"])
    assert sorted(map(key, docs.collect())) == sorted(map(key, whole.collect()))
    assert docs.where("not round_trip").count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_tables_and_more_columns(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).selectExpr("*", "1 AS batch_no", "'x' AS fp")
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert out.count() == 0
    if stage < 4:
        assert out.columns == docs.columns


@pytest.fixture(scope="module")
def texts():
    con = duckdb.connect()
    return con.execute(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet') ORDER BY doc_id").fetchall()


def collected(spark, name, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()}


def test_op5_matches_brute_force(spark, texts):
    got = collected(spark, "op5_suffix_array_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(got.values()) == sorted(brute.suffix_dedup(texts))


def test_op7_matches_brute_force(spark, texts):
    prints = [(i, brute.simhash(t)) for i, t in texts]
    want = brute.simhash_groups(prints)
    got = collected(spark, "op7_simhash_near_dedup", "fingerprint", "component_id")
    assert got == {i: (format(f, "016x"), want[i]) for i, f in prints}


def test_op10_matches_brute_force(spark, texts):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    want = brute.decontamination([t for _, t in texts], items)
    got = collected(spark, "op10_benchmark_decontamination", "n_words", "n_hit", "n_items", "items_sha256",
                    "contaminated")
    assert got == {i: (*w, w[1] > 0) for (i, _), w in zip(texts, want)}


def test_op2_and_op9_match_the_libraries(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = collected(spark, "op2_sentencepiece_transducer", "piece_ids", "round_trip")
    assert {i: (list(ids), ok) for i, (ids, ok) in got.items()} == {i: (sp.encode(t or ""), True) for i, t in texts}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, {}
    for i, text in texts:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert collected(spark, "op9_token_id_files", "start", "n_tokens", "ids_crc32") == want


def test_op4_base_columns_match_brute_force(spark, texts):
    got = collected(spark, "op4_license_signature_rules", "n_words", "n_base", "first_word", "last_word", "base_labels")
    for i, text in texts:
        w = brute.words(text)
        at = sorted((k, label) for p, label in licenses.BASE_PHRASES.items() for k in range(len(w))
                    if w[k:k + len(p.split())] == p.split())
        ends = (at[0][0], at[-1][0]) if at else (None, None)
        assert got[i] == (len(w), len(at), *ends, ",".join(sorted({label for _, label in at})))


def test_stages_take_map_columns_repeated_ids_and_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "*", "map('k', lang) AS meta", "1 AS piece_ids", "2 AS n_ids", "3 AS round_trip")
    docs = docs.unionByName(docs.where("doc_id < 20")).unionByName(
        docs.where("doc_id < 10").withColumn("doc_id", docs["doc_id"] * 0)).unionByName(
        docs.where("doc_id between 30 and 40").selectExpr("cast(null AS bigint) AS doc_id", *docs.columns[1:]))
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF)
        assert out.count() > 0, name
        if name != "sentencepiece_encoding":
            assert out.columns == docs.columns and out.schema["meta"].dataType == docs.schema["meta"].dataType
            docs = out
    assert {"piece_ids", "_piece_ids", "_n_ids", "_round_trip"} <= set(out.columns)
    assert out.where("not _round_trip or piece_ids <> 1").count() == 0


def test_op9_leaves_no_files(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    from hebdo.session import checkpoint_dir
    root = checkpoint_dir(spark).replace("file:", "", 1)
    QUERIES["op9_token_id_files"](spark, SF).count()
    assert not [f for f in os.listdir(root) if f.startswith("token-files")]
    assert before in (None, spark.sparkContext.getCheckpointDir())
