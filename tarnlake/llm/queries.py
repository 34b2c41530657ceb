"""The registered queries of the package: one for each operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import (
    best_fit, chat, hard_negatives, lexical, mixing, packing, quality, sharding, simhash, substring, token_counts,
    topk_search, toxicity,
)
from tarnlake.llm.common import settle
from tarnlake.scratch import fresh_path
from tarnlake.sources.readers import table

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(function):
    QUERIES[function.__name__] = function
    return function


@registered
def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    octets = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # The texts are read once; what is ranked is a few numbers a document.
    sizes = settle(docs.select(
        "doc_id", "source", (F.octet_length(octets) + 8).cast("long").alias("size"),
        F.crc32(octets).alias("text_crc32")), "shard-sizes")
    placed = sharding.interleave(sizes, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@registered
def op7_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measures = quality.measured(docs).withColumn("row", F.struct("row.doc_id"))
    # The counts of a document are written once, for the fit and for the verdicts.
    measures = settle(measures, "quality-measures")
    scored = quality.judged(measures, quality.fit_votes(measures))
    return scored.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"), "posterior")


@registered
def op2_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@registered
def op6_golden_ratio_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The texts are read once; what is shuffled is a few numbers a document.
    sizes = settle(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words")), "mix-sizes")
    mixed = mixing.mix(sizes, size=F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "taken_by_epoch")


@registered
def op10_budgeted_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""SELECT * FROM VALUES (-7L, 0L, 'user', '{marks}'), (-7L, 1L, 'assistant', '{marks}')
                          AS extra(conv_id, turn, role, text)""")
    windows = chat.read_back(chat.format_windows(turns.unionByName(extra)))
    # A digest is a single value of the whole conversation, so its windows meet here, in order.
    whole = windows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "new_turns", "loss_text"))).alias("windows"),
        F.sum(F.char_length("formatted")).alias("formatted_chars"))
    turns_text = F.transform(F.flatten("windows.new_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss_text = F.array_join("windows.loss_text", "")
    return whole.select(
        "conv_id", F.size(F.flatten("windows.new_turns")).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns_text, ""), 256).alias("turns_sha256"),
        F.char_length(loss_text).cast("long").alias("loss_chars"),
        F.sha2(loss_text, 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op10_budgeted_chat"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), measured AS (
    SELECT *, row_number() OVER ordered AS nth, count(*) OVER (PARTITION BY conv_id) AS n,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS tokens,
           CASE role WHEN 'assistant' THEN 8 ELSE 14 END + length(role) + length(text)
               + len(regexp_extract_all(text, '(</?s|\[/?INST)\\*[>\]]')) AS chars
    FROM turns WINDOW ordered AS (PARTITION BY conv_id ORDER BY turn, role, text)
), headed AS (
    SELECT *, nth = 1 AND role = 'system' AND n > 1 AS is_system,
           coalesce(max(CASE WHEN nth = 1 AND role = 'system' AND n > 1 THEN tokens END) OVER c, 0) AS head_tokens,
           coalesce(max(CASE WHEN nth = 1 AND role = 'system' AND n > 1 THEN chars END) OVER c, 0) AS head_chars
    FROM measured WINDOW c AS (PARTITION BY conv_id)
), summed AS (
    SELECT *, greatest(1024 - 256 - head_tokens, 1) AS room,
           sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth) AS ends FROM headed WHERE NOT is_system
), tiled AS (
    SELECT *, ends - tokens AS begins, (ends - 1) // room AS tile FROM summed
), parted AS (
    SELECT *, CASE WHEN begins // room <> tile AND sum(tokens) OVER (PARTITION BY conv_id, tile) > room
                   THEN 0 ELSE 1 END AS part FROM tiled
), spanned AS (
    SELECT *, min(begins) OVER (PARTITION BY conv_id, tile, part) AS span FROM parted
), spans AS (
    SELECT DISTINCT conv_id, span, head_chars FROM spanned
), held AS (
    SELECT s.conv_id, s.span, s.head_chars + sum(r.chars) AS chars
    FROM spans AS s JOIN spanned AS r ON r.conv_id = s.conv_id
        AND (r.span = s.span OR (r.ends <= s.span AND s.span - r.begins <= 256))
    GROUP BY s.conv_id, s.span, s.head_chars
), formatted AS (
    SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM held GROUP BY conv_id
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY nth) AS all_text,
           coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS loss_text
    FROM measured GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss_text) AS loss_chars,
       sha256(loss_text) AS loss_sha256, formatted_chars
FROM whole JOIN formatted USING (conv_id)
"""


@registered
def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@registered
def op3_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op3_fm_substring_dedup"] = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS place FROM split
), spelled AS (
    SELECT doc_id, place, array_to_string(words[place:place + 12], ' ') AS spelling FROM windows
), later AS (
    SELECT doc_id, place FROM spelled
    JOIN (SELECT spelling, min(doc_id) AS first FROM spelled GROUP BY spelling) USING (spelling)
    WHERE first < doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(place, place + 12)) AS place FROM later
), words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split
), kept AS (
    SELECT doc_id, count(*) AS n_words, count(g.place) AS n_removed,
           string_agg(word, ' ' ORDER BY w.place) FILTER (g.place IS NULL) AS kept
    FROM words AS w LEFT JOIN gone AS g USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


@registered
def op4_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


ORACLES["op4_threshold_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.parts, c.parts) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


@registered
def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sizes, features, toxic = toxicity.labelled_sets(docs, table(spark, sf_dir, "labels"))
    grades = toxicity.severity_grades(sizes, features, toxic)
    model = toxicity.fit_ordinal(sizes, features, grades, 3)
    return toxicity.grade_texts(docs, model).drop("text")


@registered
def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "token-files")
    places = token_counts.write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    counted = token_counts.scan_token_files(spark, path).select(
        number.alias("file"), "ordinal", "start", "n_tokens", "ended")
    return places.join(counted, ["file", "ordinal"], "left").select(
        "doc_id", "n_tokens", "file", "ordinal", "start", "ended")


@registered
def op11_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


ORACLES["op11_norm_bucket_search"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), items AS (
    SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (
        SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM benchmark WHERE text IS NOT NULL)
), counts AS (
    SELECT doc, doc_id, n, term, count(*) AS tf
    FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM items) GROUP BY doc, doc_id, n, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, n_docs
), impacts AS (
    SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS impact
    FROM counts JOIN weights USING (term), totals
), scores AS (
    SELECT item, item_id, doc, doc_id, CAST(sum(impact) AS BIGINT) AS score
    FROM items JOIN impacts USING (term) GROUP BY item, item_id, doc, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""


@registered
def op12_residue_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", changed)
    return hard_negatives.mine(vectors, vectors.where(F.col("vec_id") % 100 == 0))


ORACLES["op12_residue_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
           CAST(list_dot_product(a.parts, c.parts) AS BIGINT) AS score
    FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), inside AS (
    SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
    FROM positives JOIN scores USING (anchor_id)
    WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM inside WHERE place <= 10
"""


@registered
def op13_bounded_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
