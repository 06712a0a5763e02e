"""The registered queries of the operators, the pipeline, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gristmill.llm import codec, conversations, exact, fingerprints, grouptree, language, licences, near, packing, sharding, suffix, toxicity, whitening
from gristmill.plans.registry import Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op1_exact_dedup", EXACT_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(documents(spark, sf_dir), keep="max")


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return codec.round_trip(
        documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")))


REPEATS_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d WHERE length(h) >= 200),
x AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS t FROM w),
f AS (SELECT t, min(struct_pack(d := doc_id, s := s)) AS first FROM x GROUP BY t),
m AS (SELECT x.doc_id, x.s FROM x JOIN f USING (t) WHERE struct_pack(d := x.doc_id, s := x.s) <> f.first),
g AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS new FROM m),
r AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM r GROUP BY doc_id, run),
kept AS (
    SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM runs
    UNION ALL
    SELECT d.doc_id, length(d.h) // 2, coalesce(max(b), 0) FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id, d.h
),
k AS (
    SELECT d.doc_id, string_agg(substr(d.h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS h
    FROM kept JOIN d USING (doc_id) GROUP BY d.doc_id
),
n AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op2_suffix_dedup", REPEATS_SQL)
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.cut_repeats(documents(spark, sf_dir)).drop("kept_text")


NEAR_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
    FROM documents
),
s AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM w
),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c USING (doc_id)
"""


JACCARD_SQL = NEAR_SQL.replace("85 *", "90 *").replace(", s.doc_id = c.component_id AS kept", "")


@query("op10_near_dedup", NEAR_SQL)
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_copies(documents(spark, sf_dir), width=3, percent=85)


@query("op12_jaccard_join", JACCARD_SQL)
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouptree.jaccard_components(documents(spark, sf_dir), width=3, percent=90)


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("detections")


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


@query("op8_kd_sharding")
def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_languages(documents(spark, sf_dir))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


TRIE_SQL = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
codes AS (SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ord(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN
        string_split(c::VARCHAR, '')])), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
        ELSE a >> 1 END), 4294967295) % 9 AS h FROM ids),
t AS (
    SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS t, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
    FROM conversations WHERE conv_id IS NOT NULL
),
l AS (SELECT c, list(t ORDER BY p) AS l FROM t GROUP BY c),
s AS (
    SELECT codes.c, list_concat(coalesce(base.l[1:h], []), own.l[h + 1:]) AS s
    FROM codes JOIN l AS own USING (c) LEFT JOIN l AS base ON base.c = codes.c - codes.c % 5
),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s),
n AS (
    SELECT s[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256,
           CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(s[d].x)) END AS saved
    FROM p GROUP BY s[1:d], d
),
up AS (SELECT n.k[1:n.d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN up USING (k)),
a AS (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS e FROM m),
u AS (SELECT k[1:e] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY k[1:e])
SELECT m.conv_id, m.d AS depth, parent.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, u.saved_tokens, m.ends_sha256
FROM m JOIN u USING (k) LEFT JOIN n AS parent ON m.d > 0 AND parent.d = m.d - 1 AND parent.k = m.k[1:m.d - 1]
"""


@query("op13_conversation_trie", TRIE_SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
