"""Queries of the subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm import decontaminate as wu_manber
from hebdo.llm import (chat, licenses, projection_forest, quality, ranked_search, rules, sentencepiece_fst, simhash,
                       suffix_dedup, token_files, toxicity, vector_codes)
from hebdo.session import materialize, remove_folder, scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_benchmark_decontamination")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = wu_manber.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return wu_manber.hit_digest(hits, ["doc_id"]).drop("hit_spans", "items")


def fold(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts``: the rows that labels are held out by."""
    return F.expr(f"pmod(crc32(cast(cast(`{doc_id}` as string) as binary)), {parts})")


@query("op1_quality_bradley_terry")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), fold("id", 5) != 0)
    scored = quality.with_scores(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= quality.CUT).cast("int").alias("predicted"))


@query("op8_toxicity_subword_bags")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("id", 4) != 2)
    scored = toxicity.with_scores(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= toxicity.CUT).cast("int").alias("predicted"))


@query("op7_simhash_near_dedup")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query("op5_suffix_array_dedup")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digest(docs).drop("removed")


@query("op9_token_id_files")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_folder(spark, "token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), control_ids=True)
    out = materialize(token_files.read_digest(spark, path))
    remove_folder(spark, path)
    return out


@query("op2_sentencepiece_transducer")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_fst.encode_and_check(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM m WHERE len(w) >= 8),
v AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM v) x WHERE c > 1),
c AS (SELECT doc_id, CAST(count(DISTINCT i + k) AS BIGINT) AS n FROM r, (SELECT unnest(range(0, 8)) AS k) ks
      GROUP BY doc_id),
a AS (SELECT m.doc_id, n_words, word_chars, n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words
      FROM m LEFT JOIN c ON m.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols * 12 > word_chars
            OR (n_dup_lines * 2 > n_lines AND n_dup_lines >= 3)
            OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 16 * n_words))) AS kept,
       CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
            + CASE WHEN n_symbols * 12 > word_chars THEN 4 ELSE 0 END
            + CASE WHEN n_dup_lines * 2 > n_lines AND n_dup_lines >= 3 THEN 8 ELSE 0 END
            + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 16 * n_words) THEN 16 ELSE 0 END
            AS BIGINT) AS failed_bits
FROM a
"""


@query("op6_quality_rule_ledger", OP6_SQL)
def op6(spark, sf_dir):
    rows = rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       rules.failed(rules.BASE).alias("base_failed"), (~rules.failed(rules.CURRENT)).alias("kept"),
                       "failed_bits")


def ablations_sql() -> str:
    """What each policy would do without each of its rules, from the failure bits of ``OP6_SQL``."""
    rows = " UNION ALL ".join(
        f"SELECT '{p.name}' AS policy, {p.version} AS version, '{rules.RULES[k][0]}' AS rule, {p.mask} AS mask, {1 << k} AS bit"
        for p in rules.POLICIES for k in p.bits)
    return f"""
WITH ledger AS ({OP6_SQL}), r AS ({rows})
SELECT policy, CAST(version AS INTEGER) AS version, rule,
       count(*) FILTER (WHERE failed_bits & mask <> 0) AS rejected, count(*) FILTER (WHERE failed_bits & bit <> 0) AS failed,
       count(*) FILTER (WHERE failed_bits & mask = bit) AS only,
       count(*) FILTER (WHERE failed_bits & mask IN (0, bit)) AS kept_without
FROM ledger CROSS JOIN r GROUP BY policy, version, rule"""


@query("rule_ablations", ablations_sql())
def rule_ablations(spark, sf_dir):
    return rules.ablations(rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"]))


OP3_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\e') AS body,
             replace(replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\e'), chr(10), '\n') AS r,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM c),
f AS (SELECT *, length(body) + length(r) + 6 + 8 AS size, i = 0 AND role = 'system' AS sys FROM e),
s AS (SELECT conv_id, max(CASE WHEN sys THEN tokens ELSE 0 END) AS sys_tokens,
             max(CASE WHEN sys THEN size ELSE 0 END) AS sys_size, max(CASE WHEN sys THEN 1 ELSE 0 END) AS n_sys
      FROM f GROUP BY conv_id),
t AS (SELECT f.*, s.sys_tokens, s.sys_size, s.n_sys, greatest(1, 768 - s.sys_tokens) AS room,
             CASE WHEN f.sys THEN 0 ELSE f.tokens END AS k FROM f JOIN s ON f.conv_id = s.conv_id),
g AS (SELECT conv_id, i, k AS used, 0 AS w FROM t WHERE i = 0
      UNION ALL
      SELECT t.conv_id, t.i, CASE WHEN g.used > 0 AND g.used + t.k > t.room THEN t.k ELSE g.used + t.k END,
             CASE WHEN g.used > 0 AND g.used + t.k > t.room THEN g.w + 1 ELSE g.w END
      FROM g JOIN t ON t.conv_id = g.conv_id AND t.i = g.i + 1),
starts AS (SELECT conv_id, w, min(i) AS i FROM g WHERE w > 0 GROUP BY conv_id, w),
back AS (SELECT a.conv_id, a.w, t.size, t.sys_size,
                sum(t.tokens) OVER (PARTITION BY a.conv_id, a.w ORDER BY t.i DESC) AS reach
         FROM starts a JOIN t ON t.conv_id = a.conv_id AND t.i < a.i AND t.i >= t.n_sys),
extra AS (SELECT conv_id, sum(size) AS n FROM back WHERE reach <= 256 GROUP BY conv_id),
again AS (SELECT starts.conv_id, sum(s.sys_size) AS n FROM starts JOIN s ON s.conv_id = starts.conv_id
          GROUP BY starts.conv_id),
o AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
             CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
             sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
             sum(size) AS n FROM t GROUP BY conv_id)
SELECT o.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
       CAST(o.n + coalesce(extra.n, 0) + coalesce(again.n, 0) AS BIGINT) AS formatted_chars
FROM o LEFT JOIN extra ON extra.conv_id = o.conv_id LEFT JOIN again ON again.conv_id = o.conv_id
"""


@query("op3_chat_budgeted_windows", OP3_SQL)
def op3(spark, sf_dir):
    said = "\\### Assistant: </turn> ok"
    added = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, :said AS text UNION ALL "
                      "SELECT -7L, 1L, 'assistant', :said", args={"said": said})
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digest(chat.read_back(chat.windows(rows)))


@query("op4_license_signature_rules")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, ["doc_id"]).drop("detections")


def op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds unrolled: a<t> assigns each part to an entry of b<t - 1>, b<t> holds the new entries."""
    def assigned(t: int) -> str:
        return f"""
a{t} AS MATERIALIZED (
  SELECT r, p, e, dist FROM (
    SELECT r, p, e, dist, row_number() OVER (PARTITION BY r, p ORDER BY dist, e) AS n FROM (
      SELECT c.r, c.p, b.e, sum((c.v - b.v) * (c.v - b.v)) AS dist
      FROM c JOIN b{t - 1} b ON c.p = b.p AND c.d = b.d GROUP BY c.r, c.p, b.e) x) y WHERE n = 1)"""

    def refined(t: int) -> str:
        return f"""
b{t} AS MATERIALIZED (
  SELECT b.p, b.e, b.d, CASE WHEN m.n IS NULL THEN b.v
                             ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
  FROM b{t - 1} b LEFT JOIN (
    SELECT c.p, a.e, c.d, sum(c.v) AS s, count(*) AS n FROM c JOIN a{t} a ON c.r = a.r AND c.p = a.p
    GROUP BY c.p, a.e, c.d) m ON b.p = m.p AND b.e = m.e AND b.d = m.d)"""

    steps = ",".join(assigned(t) + "," + refined(t) for t in range(1, rounds + 1))
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding, len(embedding) // {parts} AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
j AS (SELECT r, w, unnest(embedding) AS x, unnest(range(len(embedding))) AS j FROM k),
c AS MATERIALIZED (SELECT r, j // w AS p, j % w AS d, CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT) AS v FROM j),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, d, v FROM c WHERE r <= {entries}),{steps},{assigned(rounds + 1)},
o AS (SELECT r, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
      FROM a{rounds + 1} GROUP BY r)
SELECT k.vec_id, k.label, o.code, o.error,
       CAST(sum(o.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, d)) FROM b{rounds}) AS codebooks_sha256
FROM k JOIN o ON k.r = o.r
"""


@query("op11_vector_code_tries", op11_sql())
def op11(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d),
q AS (SELECT i, item_id, t, count(*) AS times FROM (
        SELECT i, item_id, unnest(regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark) b) x GROUP BY i, item_id, t),
u AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d),
f AS MATERIALIZED (SELECT r, doc_id, n, t, count(*) AS tf FROM u WHERE t IN (SELECT t FROM q) GROUP BY r, doc_id, n, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM f GROUP BY t) y, s),
g AS (SELECT f.r, f.doc_id, f.t, w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * n * big_n) // big_l)))
               AS gain FROM f JOIN w ON f.t = w.t, s),
z AS (SELECT q.i, q.item_id, g.r, g.doc_id, CAST(sum(q.times * g.gain) AS BIGINT) AS score
      FROM q JOIN g ON q.t = g.t GROUP BY q.i, q.item_id, g.r, g.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM z WHERE score > 0) y WHERE rank <= 20
"""


@query("op12_hybrid_ranked_search", OP12_SQL)
def op12(spark, sf_dir):
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_projection_forest_neighbours")
def op13(spark, sf_dir):
    return projection_forest.neighbours(table(spark, sf_dir, "embeddings"))
