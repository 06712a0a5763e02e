"""Queries over the corpus tables: ingest, words, vocabularies, encoding, records, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import arrays as A
from gristmill.functions import text as X
from gristmill.functions.scalars import fingerprint, ratios_text
from gristmill.operators import bpe, corpus, encode, split, unigram, words
from gristmill.operators.ledger import reusable_outputs, stale_requests
from gristmill.plans.preprocess import learn_vocabulary, model_records
from gristmill.plans.registry import query, table
from gristmill.session import scratch
from gristmill.sources import readers, writers
from gristmill.streaming import jobs
from gristmill.streaming.sinks import drain

NONBLANK_SQL = (
    r"regexp_matches(text, '[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')"
)
OCCURRENCES_SQL = (
    r"occ AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word "
    r"FROM (SELECT doc_id, regexp_extract_all(text, ' ?\p{L}+') AS w FROM documents))"
)
ROUND_TRIP_SQL = "SELECT doc_id, md5(text) AS digest FROM documents"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_corpus(spark, f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])


def join_ints(ids):
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


# ---------------------------------------------------------------- sources


@query("S01_corpus_scan", "SELECT doc_id, length(text)::BIGINT AS chars FROM documents")
def s01(spark, d):
    return readers.read_corpus(spark, f"{d}/documents.parquet").select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("S02_row_cap", f"SELECT doc_id FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 600) WHERE {NONBLANK_SQL}")
def s02(spark, d):
    return corpus.nonblank(corpus.cap_rows(docs(spark, d), "doc_id", 600)).select("doc_id")


@query("S03_streaming_source", f"SELECT doc_id, length(text)::BIGINT AS chars FROM documents WHERE {NONBLANK_SQL}")
def s03(spark, d):
    schema = table(spark, d, "documents").schema
    stream = corpus.nonblank(jobs.corpus_stream(spark, f"{d}/documents*.parquet", schema, "doc_id"))
    out = scratch(spark, "s03")
    drain(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}"))
    return spark.read.parquet(out).select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("S04_text_column", " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS text_column, " +
    (f"count(*) FILTER (WHERE {NONBLANK_SQL})" if c == "text" else "count(*) FILTER (WHERE false)") + f" AS usable FROM {t}"
    for t, c in (("documents", "text"), ("conversations", "text"), ("benchmark", "text"), ("pages", "page_id"))
))
def s04(spark, d):
    out = None
    for name, key in (("documents", "doc_id"), ("conversations", "conv_id"), ("benchmark", "item_id"), ("pages", "page_id")):
        source = table(spark, d, name)
        one = corpus.as_corpus(source, key).agg(F.count_if(X.is_nonblank(F.col("text"))).alias("usable")).select(
            F.lit(name).alias("source_table"), F.lit(corpus.pick_text_column(source.schema)).alias("text_column"), "usable"
        )
        out = one if out is None else out.unionByName(one)
    return out


def order_records(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.array(*[F.col(c).cast("int") for c in ("o_orderkey", "o_custkey")], F.floor("o_totalprice").cast("int"),
                F.year("o_orderdate")).alias("input_ids"),
    )


@query("S05_token_records", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS record_no,
    concat_ws(',', o_orderkey, o_custkey, floor(o_totalprice)::BIGINT, year(o_orderdate)) AS ids FROM orders""")
def s05(spark, d):
    out = scratch(spark, "s05")
    writers.write_token_records(order_records(spark, d), out, 4, order="o_orderkey")
    return readers.read_token_records(spark, out, 4).select("record_no", join_ints(F.col("input_ids")).alias("ids"))


@query("S06_split_files", """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY sha256('42:' || o_orderkey)) AS rn,
    count(*) OVER () AS n FROM orders),
    s AS (SELECT o_orderkey, CASE WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'train'
        WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) + floor(n * CAST(0.05 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM o)
    SELECT split, count(*) AS records, sum(o_orderkey)::BIGINT AS first_ids FROM s GROUP BY split""")
def s06(spark, d):
    out = scratch(spark, "s06")
    writers.write_split_files(split.ratio_split(order_records(spark, d), "o_orderkey"), out, 4, order="o_orderkey")
    parts = None
    for name in writers.SPLITS:
        one = readers.read_token_records(spark, f"{out}/{name}", 4).agg(
            F.count(F.lit(1)).alias("records"), F.sum(F.get("input_ids", F.lit(0)).cast("bigint")).alias("first_ids")
        ).select(F.lit(name).alias("split"), "records", "first_ids")
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("S07_dataset_meta", """WITH c AS (SELECT count(*) AS n FROM documents), t AS (SELECT n,
    floor(n * CAST(0.9 AS DOUBLE))::BIGINT AS t, floor(n * CAST(0.05 AS DOUBLE))::BIGINT AS v FROM c)
    SELECT 10000::BIGINT AS vocab_size, 256::BIGINT AS max_seq_length, t AS train_samples, v AS val_samples,
    n - t - v AS test_samples, 256::BIGINT AS pad_token_id, 258::BIGINT AS bos_token_id, 259::BIGINT AS eos_token_id,
    257::BIGINT AS unk_token_id FROM t""")
def s07(spark, d):
    out = scratch(spark, "s07")
    writers.write_meta(writers.dataset_meta(split.ratio_split(docs(spark, d), "doc_id"), 10000, 256, A.BYTES_FIRST), out)
    names = ["vocab_size", "max_seq_length", "train_samples", "val_samples", "test_samples", "pad_token_id", "bos_token_id", "eos_token_id", "unk_token_id"]
    return spark.read.schema(", ".join(f"{n} bigint" for n in names)).json(out)


@query("S08_vocab_tsv", """SELECT p_name AS token, arg_max(p_partkey, p_partkey)::BIGINT AS id FROM part
    WHERE p_type <> 'PROMO' GROUP BY p_name""")
def s08(spark, d):
    lines = table(spark, d, "part").select(
        F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.concat_ws("\t", "p_name", "p_partkey")).alias("value"),
        F.col("p_partkey").alias("line_no"),
    )
    return readers.parse_vocab_lines(lines).select("token", F.col("id").cast("bigint").alias("id"))


@query("S09_merges_tsv", """WITH good AS (SELECT o_custkey AS left_id, year(o_orderdate) AS right_id, o_orderkey AS id,
    row_number() OVER (ORDER BY o_orderkey) - 1 AS priority FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT left_id, right_id, arg_max(id, priority) AS id, max(priority) AS priority FROM good GROUP BY left_id, right_id""")
def s09(spark, d):
    text = F.concat_ws(" ", "o_custkey", F.year("o_orderdate"), "o_orderkey")
    lines = table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("# "), text)).otherwise(text).alias("value"),
        F.col("o_orderkey").alias("line_no"),
    )
    return readers.parse_merge_lines(lines).select(*[F.col(c).cast("bigint").alias(c) for c in ("left_id", "right_id", "id", "priority")])


@query("S14_random_records", "SELECT event_id, 16::BIGINT AS n, true AS in_range FROM events")
def s14(spark, d):
    rows = readers.random_records(table(spark, d, "events"), "event_id", 16, 1000)
    return rows.select(
        "event_id", F.size("input_ids").cast("bigint").alias("n"),
        F.forall("input_ids", lambda x: (x >= 0) & (x < 1000)).alias("in_range"),
    )


# ---------------------------------------------------------------- filters


@query("P01_nonblank_text", f"""SELECT doc_id, variant, length(text)::BIGINT AS chars FROM (
    SELECT doc_id, generate_subscripts(v, 1) - 1 AS variant, unnest(v) AS text FROM (
    SELECT doc_id, [text, ' ' || chr(9) || chr(10), chr(28), chr(160), chr(8203), chr(12288) || chr(133)] AS v
    FROM documents)) WHERE {NONBLANK_SQL}""")
def p01(spark, d):
    variants = F.array("text", *[F.lit(s) for s in (" \t\n", "\x1c", "\u00a0", "\u200b", "\u3000\u0085")])
    rows = docs(spark, d).select("doc_id", F.posexplode(variants).alias("variant", "text"))
    return corpus.nonblank(rows).select("doc_id", F.col("variant").cast("bigint").alias("variant"), F.length("text").cast("bigint").alias("chars"))


@query("P02_nonempty_guard", f"SELECT count(*) AS usable FROM conversations WHERE {NONBLANK_SQL}")
def p02(spark, d):
    usable = corpus.require_rows(corpus.nonblank(corpus.as_corpus(table(spark, d, "conversations"), "conv_id")))
    return usable.agg(F.count(F.lit(1)).alias("usable"))


@query("P03_vocabulary_sample", f"SELECT doc_id FROM documents WHERE {NONBLANK_SQL} ORDER BY doc_id LIMIT 100000")
def p03(spark, d):
    return corpus.vocabulary_sample(corpus.nonblank(docs(spark, d)), size=100_000).select("doc_id")


RATIOS = "{'train': 0.9, 'validation': 0.05, 'test': 0.05}"
RATIOS_SQL = RATIOS.replace("'", "''")
REQUESTS_SQL = f"""requests AS (SELECT source AS corpus, count(*) AS n, max(n_chars) AS longest, substr(sha256(
    source || '_{RATIOS_SQL}_256_10000_' || count(*) || '_42_2'), 1, 16) AS fingerprint FROM documents GROUP BY source),
    manifest AS (SELECT source AS corpus, count(*) AS n, max(n_chars) AS longest, count(DISTINCT lang) AS langs, substr(sha256(
    source || '_{RATIOS_SQL}_256_10000_' || count(*) || '_42_2'), 1, 16) AS fingerprint
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY source)"""


def corpora(rows: DataFrame) -> DataFrame:
    """One output request per corpus (document source) with its fingerprint."""
    ratios = ratios_text(F.lit(0.9), F.lit(0.05), F.lit(0.05))
    grouped = rows.groupBy(F.col("source").alias("corpus")).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest"), F.count_distinct("lang").alias("langs")
    )
    parts = [F.col("corpus"), ratios, F.lit("256"), F.lit("10000"), F.col("n").cast("string"), F.lit("42"), F.lit("2")]
    return grouped.withColumn("fingerprint", fingerprint(*parts))


def requests_and_manifest(spark, d):
    """Current requests, and the outputs made before the toxic documents came in."""
    all_docs = table(spark, d, "documents")
    toxic = table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    return corpora(all_docs), corpora(all_docs.join(toxic, "doc_id", "left_anti"))


@query("F12_fingerprint", f"WITH {REQUESTS_SQL} SELECT corpus, fingerprint FROM requests")
def f12(spark, d):
    return requests_and_manifest(spark, d)[0].select("corpus", "fingerprint")


@query("P07_reusable_outputs", f"""WITH {REQUESTS_SQL}
    SELECT r.corpus, coalesce(m.longest < 30000 AND r.fingerprint = m.fingerprint AND m.langs >= 3, false) AS reusable
    FROM requests r LEFT JOIN manifest m USING (corpus)""")
def p07(spark, d):
    requests, made = requests_and_manifest(spark, d)
    manifest = made.select(
        "corpus", "fingerprint", F.lit(True).alias("files_exist"), (F.col("longest") < 30000).alias("completed"),
        F.lit(True).alias("tokenizer_trained"), F.lit(True).alias("data_tokenized"),
    )
    meta = made.select("corpus", F.lit(256).alias("meta_length"), F.when(F.col("langs") >= 3, 10000).otherwise(9000).alias("meta_vocab"))
    sizes = made.select("corpus", F.lit(10000).alias("tokens"))
    asked = requests.select("corpus", "fingerprint", F.lit(256).alias("max_seq_length"), F.lit(10000).alias("vocab_size"))
    return reusable_outputs(asked, manifest, meta, sizes).select("corpus", "reusable")


@query("P07_each_condition", """WITH m AS (SELECT o_custkey, max(o_orderkey) AS latest, max(o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS made,
        max(o_totalprice) > 100000 AS files_exist, bool_or(o_orderstatus = 'F') AS completed, bool_or(o_orderpriority = '1-URGENT') AS trained,
        bool_or(o_orderpriority = '5-LOW') AS tokenized, min(o_totalprice) < 100000 AS same_length, count(*) AS recorded,
        count(*) FILTER (WHERE o_totalprice > 2000) AS tokens FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS corpus, coalesce(files_exist AND completed AND trained AND tokenized AND latest = made AND same_length
        AND recorded = tokens AND tokens >= 5, false) AS reusable FROM customer LEFT JOIN m ON c_custkey = o_custkey""")
def p07_each(spark, d):
    """A customer stands for a corpus: each condition is false for some of them."""
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    made = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("corpus")).agg(
        F.max("o_orderkey").alias("latest"), F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))).alias("fingerprint"),
        (F.max(price) > 100000).alias("files_exist"), F.bool_or(F.col("o_orderstatus") == "F").alias("completed"),
        F.bool_or(priority == "1-URGENT").alias("tokenizer_trained"), F.bool_or(priority == "5-LOW").alias("data_tokenized"),
        F.when(F.min(price) < 100000, 256).otherwise(128).alias("meta_length"),
        F.count(F.lit(1)).alias("meta_vocab"), F.count_if(price > 2000).alias("tokens"),
    )
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("corpus")).join(
        made.select("corpus", F.col("latest").alias("fingerprint")), "corpus", "left"
    ).select("corpus", "fingerprint", F.lit(256).alias("max_seq_length"), F.lit(5).alias("vocab_size"))
    manifest = made.select("corpus", "fingerprint", "files_exist", "completed", "tokenizer_trained", "data_tokenized")
    meta, sizes = made.select("corpus", "meta_length", "meta_vocab"), made.select("corpus", "tokens")
    return reusable_outputs(asked, manifest, meta, sizes).select("corpus", "reusable")


STALE_SQL = f"WITH {REQUESTS_SQL}, stale AS (SELECT corpus FROM requests r WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.corpus = r.corpus AND m.fingerprint = r.fingerprint))"


@query("P08_stale_corpora", f"{STALE_SQL} SELECT corpus FROM stale")
def p08(spark, d):
    return stale_requests(*requests_and_manifest(spark, d)).select("corpus")


@query("T07_incremental_resume", f"""{STALE_SQL} SELECT source AS corpus, count(*) AS docs, sum(length(text))::BIGINT AS chars
    FROM documents WHERE source IN (SELECT corpus FROM stale) GROUP BY source""")
def t07(spark, d):
    stale = stale_requests(*requests_and_manifest(spark, d)).select(F.col("corpus").alias("source"))
    return table(spark, d, "documents").join(stale, "source", "left_semi").groupBy(F.col("source").alias("corpus")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )


# ---------------------------------------------------------------- words and vocabularies


@query("A01_letter_word_freq", rf"""WITH {OCCURRENCES_SQL}
    SELECT word, count(*) AS freq, min({{'d': doc_id, 'p': pos}}).d AS first_doc, min({{'d': doc_id, 'p': pos}}).p::BIGINT AS first_pos
    FROM occ GROUP BY word""")
def a01_letters(spark, d):
    freq = words.word_table(docs(spark, d), X.letter_words(F.col("text")))
    return freq.select("word", "freq", F.col("first._doc").alias("first_doc"), F.col("first._pos").cast("bigint").alias("first_pos"))


# The SQL engine has no lookahead. A mark before the last white space of a run that is followed
# by other text splits the run where the pattern's lookahead would.
SPACE_SQL = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PRETOKENS_SQL = rf"""occ AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT doc_id,
    regexp_extract_all(regexp_replace(text, '({SPACE_SQL})({SPACE_SQL.replace('[', '[^', 1)})', chr(57344) || '\1\2', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}\x{{e000}}{SPACE_SQL[1:-1]}]+|{SPACE_SQL}+') AS w FROM documents))"""


@query("A01_pretoken_freq", f"WITH {PRETOKENS_SQL} SELECT word, count(*) AS freq FROM occ GROUP BY word")
def a01(spark, d):
    return words.word_table(docs(spark, d)).select("word", "freq")


SYMBOLS_SQL = rf"""{OCCURRENCES_SQL},
    w AS (SELECT word, count(*) AS freq, min({{'d': doc_id, 'p': pos}}) AS first FROM occ GROUP BY word),
    s AS (SELECT freq, first, list_transform(range(1, octet_length(encode(word)) + 1),
        lambda i: chr(CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS INTEGER) + 256)) AS symbols FROM w),
    p AS (SELECT freq, first, unnest(range(1, len(symbols))) AS j, symbols FROM s)"""


def letter_symbols(spark, d):
    freq = words.word_table(docs(spark, d), X.letter_words(F.col("text")))
    return bpe.numbered(freq.select(X.byte_string(F.col("word")).alias("symbols"), "freq", "first"))


@query("A02_pair_freq", rf"""WITH {SYMBOLS_SQL} SELECT (ascii(symbols[j]) - 256)::BIGINT AS left_byte,
    (ascii(symbols[j + 1]) - 256)::BIGINT AS right_byte, sum(freq)::BIGINT AS freq FROM p GROUP BY 1, 2""")
def a02(spark, d):
    pairs = words.pair_table(letter_symbols(spark, d))
    return pairs.select(
        F.ascii(F.substring("pair", 1, 1)).cast("bigint").alias("left_byte"),
        F.ascii(F.substring("pair", 2, 1)).cast("bigint").alias("right_byte"), "freq",
    )


@query("A03_top_pair", rf"""WITH {SYMBOLS_SQL}, f AS (SELECT (ascii(symbols[j]) - 256)::BIGINT AS left_byte,
    (ascii(symbols[j + 1]) - 256)::BIGINT AS right_byte, sum(freq)::BIGINT AS freq, min({{'f': first, 'j': j}}) AS first FROM p GROUP BY 1, 2)
    SELECT left_byte, right_byte, freq FROM f ORDER BY freq DESC, first LIMIT 25""")
def a03(spark, d):
    top = words.top_pairs(words.pair_table(letter_symbols(spark, d)), 25)
    return top.select(
        F.ascii(F.substring("pair", 1, 1)).cast("bigint").alias("left_byte"),
        F.ascii(F.substring("pair", 2, 1)).cast("bigint").alias("right_byte"), "freq",
    )


@query("A18_vocabulary_size", r"SELECT max(p_partkey) + 1 AS by_id, count(DISTINCT p_partkey) AS by_count FROM part")
def a18(spark, d):
    return words.vocabulary_size(table(spark, d, "part"), "p_partkey")


# One recursion step holds all words with their symbols, the round's best pair applied.
MERGE_ROUNDS_SQL = rf"""
    w AS (SELECT word, count(*) AS freq, min({{'d': doc_id, 'p': pos}}) AS first FROM occ GROUP BY word),
    s AS (SELECT word, freq, row_number() OVER (ORDER BY first) AS place, array_to_string(list_transform(range(1, octet_length(encode(word)) + 1),
        lambda i: chr(CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS INTEGER) + 256)), '') AS symbols FROM w),
    r(round, freq, place, symbols, pair, pair_freq) AS (
        SELECT 0, freq, place, symbols, '', 0::BIGINT FROM s
        UNION ALL
        (WITH now AS (SELECT * FROM r),
            p AS (SELECT freq, place, symbols, unnest(range(1, length(symbols))) AS j FROM now),
            best AS (SELECT substr(symbols, j, 2) AS pair, sum(freq)::BIGINT AS f, min({{'p': place, 'j': j}}) AS first
                FROM p GROUP BY 1 ORDER BY f DESC, first LIMIT 1)
        SELECT now.round + 1, freq, place, replace(symbols, best.pair, chr(600 + now.round)), best.pair, best.f
        FROM now, best WHERE now.round < 40))"""
MERGES_SQL = MERGE_ROUNDS_SQL + """
    SELECT round::BIGINT AS merge_no, ascii(substr(any_value(pair), 1, 1))::BIGINT AS left_symbol,
        ascii(substr(any_value(pair), 2, 1))::BIGINT AS right_symbol, any_value(pair_freq) AS freq
    FROM r WHERE round > 0 GROUP BY round"""

# After the last round the symbols of a word are its encoding: bytes from 256 and merges from 600 here, 0 and 260 there.
# That holds as no two rules make the same bytes, which `_ids_digest` asserts on the other side.
ENCODED_SQL = rf"""WITH RECURSIVE {PRETOKENS_SQL}, {MERGE_ROUNDS_SQL},
    last AS (SELECT place, array_to_string([CASE WHEN unicode(c) < 600 THEN unicode(c) - 256 ELSE unicode(c) - 340 END
        FOR c IN string_split(symbols, '')], ',') AS ids FROM r WHERE round = (SELECT max(round) FROM r)),
    of_word AS (SELECT s.word, last.ids FROM s JOIN last USING (place))
"""
IDS_SQL = ENCODED_SQL + """    SELECT d.doc_id, coalesce(md5(string_agg(of_word.ids, ',' ORDER BY occ.pos)), md5('')) AS digest
    FROM documents d LEFT JOIN occ USING (doc_id) LEFT JOIN of_word USING (word) GROUP BY d.doc_id"""
# The record of a text: BOS, at most 254 ids, EOS, filled up with PAD.
RECORDS_SQL = ENCODED_SQL + """, lists AS (SELECT d.doc_id, coalesce(string_split(string_agg(of_word.ids, ',' ORDER BY occ.pos), ','), []) AS ids
        FROM documents d LEFT JOIN occ USING (doc_id) LEFT JOIN of_word USING (word) GROUP BY d.doc_id)
    SELECT doc_id, 256::BIGINT AS length, md5(array_to_string(list_concat(list_concat(list_concat(['258'], ids[1:254]), ['259']),
        ['256' FOR i IN range(least(254, 254 - len(ids)))]), ',')) AS digest FROM lists"""


@query("K01_bpe_letters", f"WITH RECURSIVE {OCCURRENCES_SQL}, {MERGES_SQL}")
def k01_letters(spark, d):
    freq = words.word_table(docs(spark, d), X.letter_words(F.col("text")))
    return merge_symbols(spark, bpe.train_bpe(freq, 260 + 40))


def merge_symbols(spark, rules: bpe.Rules) -> DataFrame:
    """Merges in the numbering of the SQL: bytes from 256, the n-th merge 600 + n."""
    number = {bytes([b]): 256 + b for b in range(256)}
    rows = []
    for i, m in enumerate(rules.merges):
        rows.append((i + 1, number[m.left], number[m.right], m.freq))
        number.setdefault(m.left + m.right, 600 + i)
    return spark.createDataFrame(rows, "merge_no bigint, left_symbol bigint, right_symbol bigint, freq bigint")


def learnt(spark, d, extra: int = 40, layout=A.BYTES_FIRST) -> bpe.Rules:
    return learn_vocabulary(corpus.nonblank(docs(spark, d)), 260 + extra, layout)


@query("K01_bpe_train", f"WITH RECURSIVE {PRETOKENS_SQL}, {MERGES_SQL}")
def k01(spark, d):
    return merge_symbols(spark, learnt(spark, d))


@query("S08_tokenizer_file", f"""SELECT 259 + merge_no AS id, left_symbol, right_symbol, NULL::VARCHAR AS special
    FROM (WITH RECURSIVE {PRETOKENS_SQL}, {MERGES_SQL})
    UNION ALL SELECT * FROM (VALUES (256::BIGINT, NULL::BIGINT, NULL::BIGINT, '<PAD>'), (257, NULL, NULL, '<UNK>'), (258, NULL, NULL, '<BOS>'), (259, NULL, NULL, '<EOS>'))""")
def s08_file(spark, d):
    """The vocabulary learnt from all documents, saved as a file; its merges and special tokens as read back from there."""
    rules, out = learnt(spark, d), scratch(spark, "s08")
    special = spark.createDataFrame(list(rules.layout.specials.items()), "token string, id int")
    writers.write_tokenizer_json(rules.vocab_df(spark), rules.merges_df(spark), special, out)
    read = readers.read_tokenizer_json(spark, out)
    # Numbers of the SQL: bytes from 256, merges from 600.
    symbol = F.when(F.col("id") < 256, F.col("id") + 256).otherwise(F.col("id") + 340).cast("bigint")
    of = lambda side: F.broadcast(read["vocab"].select(F.col("token").alias(side), symbol.alias(f"{side}_symbol")))
    merges = read["merges"].join(of("left"), "left").join(of("right"), "right").withColumn("special", F.lit(None).cast("string"))
    rows = read["special_tokens"].select("id", *[F.lit(None).cast("bigint").alias(f"{s}_symbol") for s in ("left", "right")], F.col("token").alias("special"))
    return merges.select("id", "left_symbol", "right_symbol", "special").unionByName(rows).withColumn("id", F.col("id").cast("bigint"))


@query("K02_bpe_specials_first", f"SELECT *, 259 + merge_no AS id, 0::BIGINT AS pad, 3::BIGINT AS unk FROM (WITH RECURSIVE {PRETOKENS_SQL}, {MERGES_SQL})")
def k02(spark, d):
    rules = learnt(spark, d, layout=A.SPECIALS_FIRST)
    special = {t: i for i, t in rules.vocabulary().items() if t in (b"<PAD>", b"<UNK>")}
    ids = rules.merges_df(spark).select((F.col("rank") + 1).cast("bigint").alias("merge_no"), F.col("id").cast("bigint").alias("id"))
    return merge_symbols(spark, rules).join(ids, "merge_no").withColumn("pad", F.lit(special[b"<PAD>"]).cast("bigint")).withColumn(
        "unk", F.lit(special[b"<UNK>"]).cast("bigint")
    )


# Leading characters keep their code point, inner ones are moved up, merges come after both.
WORDPIECE_SQL = r"""WITH RECURSIVE occ AS (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+|[^\s\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')) AS word FROM documents),
    w AS (SELECT word, count(*) AS freq FROM occ GROUP BY word),
    s AS (SELECT freq, substr(word, 1, 1) || coalesce(array_to_string(list_transform(range(2, length(word) + 1), lambda i: chr(ascii(substr(word, i, 1)) + 131072)), ''), '') AS symbols FROM w),
    r(round, freq, symbols, pair, pair_freq) AS (
        SELECT 0, freq, symbols, '', 0::BIGINT FROM s
        UNION ALL
        (WITH now AS (SELECT * FROM r),
            p AS (SELECT freq, symbols, unnest(range(1, length(symbols))) AS j FROM now),
            best AS (SELECT substr(symbols, j, 2) AS pair, sum(freq)::BIGINT AS f FROM p GROUP BY 1 ORDER BY f DESC, pair LIMIT 1)
        SELECT now.round + 1, freq, replace(symbols, best.pair, chr(262144 + now.round)), best.pair, best.f
        FROM now, best WHERE now.round < 40))
    SELECT round::BIGINT AS merge_no, ascii(substr(any_value(pair), 1, 1))::BIGINT AS left_symbol,
        ascii(substr(any_value(pair), 2, 1))::BIGINT AS right_symbol, any_value(pair_freq) AS freq
    FROM r WHERE round > 0 GROUP BY round"""


@query("K03_wordpiece_train", WORDPIECE_SQL)
def k03(spark, d):
    rules = bpe.train_wordpiece(words.word_table(docs(spark, d), X.plain_words(F.col("text"))), 0, merges=40)
    number = {}
    for token in rules.alphabet:
        inner = token.startswith(b"##") and len(token) > 2
        number[token] = ord(token[2 if inner else 0:].decode()) + (131072 if inner else 0)
    rows = []
    for i, m in enumerate(rules.merges):
        rows.append((i + 1, number[m.left], number[m.right], m.freq))
        number.setdefault(bpe.joined(m.left, m.right, b"##"), 262144 + i)
    return spark.createDataFrame(rows, "merge_no bigint, left_symbol bigint, right_symbol bigint, freq bigint")


@query("K04_substring_counts", rf"""WITH {OCCURRENCES_SQL}, w AS (SELECT word, count(*) AS freq FROM occ GROUP BY word),
    s AS (SELECT word, freq, unnest(range(1, length(word) + 1)) AS i FROM w),
    p AS (SELECT freq, word, i, unnest(range(1, least(16, length(word) - i + 1) + 1)) AS n FROM s),
    c AS (SELECT substr(word, i, n) AS piece, sum(freq)::BIGINT AS freq FROM p GROUP BY 1)
    SELECT length(piece)::BIGINT AS chars, count(*) AS pieces, sum(freq)::BIGINT AS occurrences, max(freq) AS most FROM c GROUP BY 1""")
def k04_substrings(spark, d):
    counts = unigram.substring_counts(words.word_table(docs(spark, d), X.letter_words(F.col("text"))))
    return counts.groupBy(F.length("piece").cast("bigint").alias("chars")).agg(
        F.count(F.lit(1)).alias("pieces"), F.sum("freq").alias("occurrences"), F.max("freq").alias("most")
    )


# Forward and backward sums over the positions of each distinct word, for pieces of up to three letters.
EXPECTED_SQL = rf"""WITH RECURSIVE {OCCURRENCES_SQL},
    w AS (SELECT word, count(*) AS freq, length(word) AS n FROM occ GROUP BY word),
    c AS (SELECT piece, sum(freq)::DOUBLE AS f FROM (SELECT substr(word, i, k) AS piece, freq FROM
        (SELECT word, freq, n, unnest(range(1, n + 1)) AS i FROM w), (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= n) GROUP BY piece),
    p AS (SELECT piece, f / (SELECT sum(f) FROM c WHERE length(piece) = 1 OR f > 1) AS p FROM c WHERE length(piece) = 1 OR f > 1),
    fwd(word, n, j, a1, a2, a3) AS (SELECT word, n, 0, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM w
        UNION ALL SELECT f.word, f.n, f.j + 1, a1 * coalesce(x.p, 0) + a2 * coalesce(y.p, 0) + a3 * coalesce(z.p, 0), a1, a2
        FROM fwd f LEFT JOIN p x ON x.piece = substr(f.word, f.j + 1, 1) LEFT JOIN p y ON f.j >= 1 AND y.piece = substr(f.word, f.j, 2)
        LEFT JOIN p z ON f.j >= 2 AND z.piece = substr(f.word, f.j - 1, 3) WHERE f.j < f.n),
    bwd(word, n, j, b1, b2, b3) AS (SELECT word, n, n, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM w
        UNION ALL SELECT b.word, b.n, b.j - 1, b1 * coalesce(x.p, 0) + b2 * coalesce(y.p, 0) + b3 * coalesce(z.p, 0), b1, b2
        FROM bwd b LEFT JOIN p x ON x.piece = substr(b.word, b.j, 1) LEFT JOIN p y ON b.j + 1 <= b.n AND y.piece = substr(b.word, b.j, 2)
        LEFT JOIN p z ON b.j + 2 <= b.n AND z.piece = substr(b.word, b.j, 3) WHERE b.j > 0),
    arcs AS (SELECT f.word, f.a1 AS a, b.b1 AS b, p.p, p.piece FROM fwd f, (SELECT unnest([1, 2, 3]) AS k), p, bwd b
        WHERE f.j + k <= f.n AND p.piece = substr(f.word, f.j + 1, k) AND b.word = f.word AND b.j = f.j + k),
    total AS (SELECT word, a1 AS t FROM fwd WHERE j = n)
    SELECT piece, round(sum(w.freq * a * p / t * b), 2) AS expected FROM arcs JOIN total USING (word) JOIN w USING (word) GROUP BY piece"""


@query("K04_expected_counts", EXPECTED_SQL)
def k04_expected(spark, d):
    table_of_words = words.word_table(docs(spark, d), X.letter_words(F.col("text"))).select("word", "freq")
    counts = unigram.substring_counts(table_of_words, 3).filter((F.length("piece") == 1) | (F.col("freq") > 1))
    return unigram.expected_counts_of_table(table_of_words, counts, 3).select("piece", F.round("expected", 2).alias("expected"))


@query("K04_unigram_train")
def k04(spark, d):
    freq = words.word_table(docs(spark, d), X.plain_words(F.col("text")))
    vocab = unigram.train_unigram(freq, 3000)
    return vocab.select(F.col("id").cast("bigint").alias("id"), "piece", F.round("logp", 6).alias("logp"))


# ---------------------------------------------------------------- encoding


@query("F01_pretokens", ROUND_TRIP_SQL)
def f01(spark, d):
    return docs(spark, d).select("doc_id", F.md5(F.array_join(X.pretokens(F.col("text")), "").cast("binary")).alias("digest"))


@query("F02_utf8_bytes", "SELECT item_id, hex(encode(text)) AS bytes FROM benchmark")
def f02(spark, d):
    return table(spark, d, "benchmark").select(
        "item_id", F.array_join(F.transform(X.utf8_bytes(F.col("text")), lambda b: F.hex(b)), "").alias("bytes")
    )


@query("F03_printable_bytes", "SELECT doc_id, md5(text) AS digest, octet_length(encode(text))::BIGINT AS symbols FROM documents")
def f03(spark, d):
    shown = docs(spark, d).select("doc_id", X.printable_bytes(F.col("text")).alias("shown"))
    return shown.select(
        "doc_id", F.md5(X.text_of_printable(F.col("shown")).cast("binary")).alias("digest"), F.length("shown").cast("bigint").alias("symbols")
    )


def _digest_of_ids(rows: DataFrame, rules: bpe.Rules) -> DataFrame:
    return rows.select("doc_id", F.md5(encode.decoded(F.col("ids"), rules).cast("binary")).alias("digest"))


def _ids_digest(rows: DataFrame, rules: bpe.Rules) -> DataFrame:
    tokens = list(rules.vocabulary().values())
    assert len(tokens) == len(set(tokens)), "two rules make the same bytes"
    return rows.select("doc_id", F.md5(join_ints(F.col("ids")).cast("binary")).alias("digest"))


@query("F04_encode_texts", IDS_SQL)
def f04(spark, d):
    rules = learnt(spark, d)
    return _ids_digest(encode.encode_texts(docs(spark, d), rules), rules)


@query("F05_encode_whole_texts", ROUND_TRIP_SQL)
def f05(spark, d):
    rules = learnt(spark, d)
    return _digest_of_ids(encode.encode_whole_texts(docs(spark, d), rules), rules)


@query("F06_decode_wrapped", ROUND_TRIP_SQL)
def f06(spark, d):
    rules = learnt(spark, d, layout=A.SPECIALS_FIRST)
    rows = encode.encode_texts(docs(spark, d), rules)
    return _digest_of_ids(rows.withColumn("ids", A.wrap(F.col("ids"), rules.layout)), rules)


@query("J01_encode_distinct_words", IDS_SQL)
def j01(spark, d):
    rules = learnt(spark, d)
    return _ids_digest(encode.encode_by_distinct_word(docs(spark, d), rules), rules)


@query("J10_encoder_agreement", "SELECT count(*) AS total, count(*) AS matches, 0::BIGINT AS mismatches, 1.0::DOUBLE AS rate FROM documents")
def j10(spark, d):
    rules = learnt(spark, d)
    texts = docs(spark, d)
    compared = encode.agreement(encode.encode_texts(texts, rules), encode.encode_by_distinct_word(texts, rules), "doc_id", "ids")
    return encode.agreement_report(compared)


@query("A16_agreement_report", """WITH c AS (SELECT d.doc_id, (length(d.text) = d.n_chars) AND l.quality = 1 AS same
    FROM documents d JOIN labels l USING (doc_id)) SELECT count(*) AS total, count(*) FILTER (WHERE same) AS matches,
    count(*) FILTER (WHERE NOT same) AS mismatches, round(coalesce(count(*) FILTER (WHERE same) / nullif(count(*), 0), 0), 6)::DOUBLE AS rate FROM c""")
def a16(spark, d):
    left = table(spark, d, "documents").select("doc_id", (F.length("text") == F.col("n_chars")).alias("v"))
    right = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("v"))
    return encode.agreement_report(encode.agreement(left, right, "doc_id", "v")).withColumn("rate", F.round("rate", 6))


@query("J02_tokens_of_ids", """SELECT l_suppkey AS doc_id, count(*) AS tokens, count(DISTINCT p_name) AS names,
    sum(length(p_name))::BIGINT AS chars FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""")
def j02(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.array("l_partkey").alias("ids"))
    vocab = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("token"))
    return encode.tokens_of_ids(rows, vocab, "doc_id", "ids").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("tokens"), F.countDistinct("token").alias("names"), F.sum(F.length("token")).cast("bigint").alias("chars")
    )


@query("J03_ids_of_tokens", rf"""WITH {OCCURRENCES_SQL}, v AS (SELECT word, row_number() OVER (ORDER BY word) + 3 AS id FROM
    (SELECT DISTINCT unnest(regexp_extract_all(text, ' ?\p{{L}}+')) AS word FROM benchmark))
    SELECT doc_id, count(*) AS tokens, count(*) FILTER (WHERE v.word IS NULL) AS unknown FROM occ LEFT JOIN v USING (word) GROUP BY doc_id""")
def j03(spark, d):
    found = table(spark, d, "benchmark").select(F.explode(X.letter_words(F.col("text"))).alias("token")).distinct()
    vocab = bpe.numbered(found, ["token"], "id").select("token", (F.col("id") + 4).alias("id"))
    rows = docs(spark, d).select("doc_id", F.explode(X.letter_words(F.col("text"))).alias("word"))
    looked_up = encode.vocabulary_lookup(rows, vocab, "word", A.SPECIALS_FIRST.unk)
    return looked_up.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("tokens"), F.count_if(F.col("id") == A.SPECIALS_FIRST.unk).alias("unknown")
    )


# ---------------------------------------------------------------- records (ids from embedding values)

IDS_SQL = "ids AS (SELECT vec_id, list_transform(embedding, lambda x: floor(abs(x::DOUBLE) * 100)::INTEGER) AS ids FROM embeddings)"


def vector_ids(spark, d):
    value = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 100).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", value.alias("ids"))


@query("F07_wrap", f"WITH {IDS_SQL} SELECT vec_id, array_to_string([258] || ids || [259], ',') AS ids FROM ids")
def f07(spark, d):
    return vector_ids(spark, d).select("vec_id", join_ints(A.wrap(F.col("ids"), A.BYTES_FIRST)).alias("ids"))


@query("F08_pair_template", f"""WITH {IDS_SQL} SELECT vec_id, array_to_string([1] || ids[1:20] || [2] || ids[21:64] || [2], ',') AS ids,
    array_to_string(list_transform(range(67), lambda i: CASE WHEN i < 22 THEN 0 ELSE 1 END), ',') AS segments FROM ids""")
def f08(spark, d):
    a, b = F.slice("ids", 1, 20), F.slice("ids", 21, 44)
    return vector_ids(spark, d).select(
        "vec_id", join_ints(A.wrap_pair(a, b, A.SPECIALS_FIRST)).alias("ids"), join_ints(A.pair_segments(a, b)).alias("segments")
    )


@query("F09_pad", f"""WITH {IDS_SQL} SELECT vec_id, array_to_string([258] || ids[1:38] || [259], ',') AS cut,
    array_to_string([258] || ids || [259] || list_transform(range(14), lambda i: 256), ',') AS filled FROM ids""")
def f09(spark, d):
    return vector_ids(spark, d).select(
        "vec_id", join_ints(A.pad_to(F.col("ids"), 40, A.BYTES_FIRST)).alias("cut"),
        join_ints(A.pad_to(F.col("ids"), 80, A.BYTES_FIRST)).alias("filled"),
    )


@query("F10_labels_mask", f"""WITH {IDS_SQL} SELECT vec_id, array_to_string(list_transform(ids, lambda x: CASE WHEN x = 0 THEN -1 ELSE x END), ',') AS labels,
    array_to_string(list_transform(ids, lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END), ',') AS mask FROM ids""")
def f10(spark, d):
    record = A.model_input(F.col("ids"), 0)
    return vector_ids(spark, d).select("vec_id", record.alias("r")).select(
        "vec_id", join_ints(F.col("r.labels")).alias("labels"), join_ints(F.col("r.attention_mask")).alias("mask")
    )


PAIRS_SQL = f"""{IDS_SQL}, pairs AS (SELECT vec_id, unnest(range(1, len(ids))) AS j, ids FROM ids),
    t AS (SELECT vec_id, ids[j]::BIGINT AS input, CASE WHEN ids[j + 1] = 0 THEN -1 ELSE ids[j + 1] END::BIGINT AS target FROM pairs)"""


def token_pairs(spark, d):
    pairs = A.next_token_pairs(F.col("ids"), A.label_ids(F.col("ids"), 0))
    return vector_ids(spark, d).select("vec_id", F.inline(pairs)).withColumn("input", F.col("input").cast("bigint"))


@query("F11_next_token_pairs", f"WITH {PAIRS_SQL} SELECT input, target, count(*) AS n FROM t GROUP BY input, target")
def f11(spark, d):
    return token_pairs(spark, d).groupBy("input", "target").agg(F.count(F.lit(1)).alias("n"))


@query("A15_masked_mean", f"""WITH {PAIRS_SQL} SELECT vec_id, round(avg(ln(1 + abs(input - target))) FILTER (WHERE target <> -1), 6) AS loss,
    count(*) FILTER (WHERE target <> -1) AS targets FROM t GROUP BY vec_id""")
def a15(spark, d):
    from gristmill.operators.metrics import masked_mean

    scored = token_pairs(spark, d).withColumn("score", F.ln(1 + F.abs(F.col("input") - F.col("target"))))
    return masked_mean(scored, ["vec_id"]).withColumn("loss", F.round("loss", 6))


# ---------------------------------------------------------------- order, split, batches

SPLIT_SQL = """h AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents),
    split AS (SELECT doc_id, CASE WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'train'
        WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) + floor(n * CAST(0.05 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM h)"""


@query("W01_permutation", f"WITH {SPLIT_SQL} SELECT doc_id, rn AS pos FROM h")
def w01(spark, d):
    return split.permute(docs(spark, d).select("doc_id"), "doc_id")


@query("W02_ratio_split", f"WITH {SPLIT_SQL} SELECT doc_id, split FROM split")
def w02(spark, d):
    return split.ratio_split(docs(spark, d).select("doc_id"), "doc_id")


@query("A04_split_counts", f"WITH {SPLIT_SQL} SELECT split, count(*) AS n, sum(4 * 64)::BIGINT AS bytes FROM split GROUP BY split")
def a04(spark, d):
    rules = learnt(spark, d, 8)
    return split.split_sizes(model_records(docs(spark, d), rules, 64), "input_ids")


@query("W03_batches", f"""WITH {SPLIT_SQL}, t AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) AS rn,
    count(*) OVER () AS n FROM split WHERE split = 'train') SELECT doc_id, (rn - 1) // 32 AS batch_id FROM t WHERE (rn - 1) // 32 < n // 32""")
def w03(spark, d):
    train = split.ratio_split(docs(spark, d).select("doc_id"), "doc_id").filter("split = 'train'")
    return split.batches(train.select("doc_id"), "doc_id", 32)


@query("W03_batches_in_order", """WITH t AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)
    SELECT doc_id, (rn - 1) // 32 AS batch_id FROM t WHERE (rn - 1) // 32 < n // 32""")
def w03_ordered(spark, d):
    return split.batches(docs(spark, d).select("doc_id"), "doc_id", 32, shuffle=False)


@query("W04_cycle", """WITH n AS (SELECT count(*) // 32 AS nb FROM documents), e AS (SELECT unnest(range(20)) AS epoch),
    o AS (SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY sha256('42:' || epoch || ':' || doc_id), doc_id) AS rn FROM documents, e)
    SELECT epoch * nb + (rn - 1) // 32 + 1 AS step, epoch, doc_id FROM o, n
    WHERE (rn - 1) // 32 < nb AND epoch * nb + (rn - 1) // 32 + 1 <= 100""")
def w04(spark, d):
    return split.cycle(docs(spark, d).select("doc_id"), "doc_id", 32, 100)
