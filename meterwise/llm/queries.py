"""The registered queries of this subpackage: thin wrappers that apply each operator to
its whole table with production parameters, and derive the columns to compare."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm import (
    chat, decontamination, fill_middle, filter_audit, interpolation, lines, minhash, packing,
    quality, repeats, sharding, token_files, toxicity,
)
from meterwise.llm.common import shared_folder, table, tuned

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tuned(spark), sf_dir.rstrip("/"))

    _QUERIES[fn.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def statements() -> dict[str, str]:
    return dict(_ORACLE)


# --- 1: token files -----------------------------------------------------------


@query
def op1_token_files(spark, sf_dir):
    path = shared_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


# --- 2: best-fit packing ------------------------------------------------------


def packed(docs: DataFrame) -> DataFrame:
    # A worker that does nothing else has the memory for twice the words.
    return packing.best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cached=2_000_000)


@query
def op2_best_fit_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "sequence_id", "offset",
    )


# --- 3: chat formatting -----------------------------------------------------------

_TEXT = chat.Field("string", low=1, high=400)
SCHEMAS = {
    "answer": {"text": _TEXT, "limit": chat.Field("integer", low=0, high=40)},
    "search": {
        "text": _TEXT,
        "limit": chat.Field("integer", low=0, high=40),
        "exact": chat.Field("boolean", required=False),
    },
}


def calls_and_results(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as tool calls: each user turn calls a tool and depends on the user
    turn two before, each assistant turn is the result of the turn before."""
    ident = lambda back: F.format_string("c%d-%d", "conv_id", F.col("turn") - back)
    quoted = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text")))
    arguments = F.concat(
        F.substring(quoted, 1, 1), F.lit(' "limit" : '),
        (F.length(F.coalesce("text", F.lit(""))) % 50).cast("string"), F.lit(", "),
        F.when(F.col("turn") % 4 == 2, '"exact":true, ').otherwise(""), F.expr("substring(q, 2)"),
    )
    user = turns.where("role = 'user'").withColumn("q", quoted)
    calls = user.select(
        "conv_id", "turn", ident(0).alias("call_id"),
        F.when(F.col("turn") % 4 == 3, "lookup").when(F.col("turn") % 4 == 2, "search")
        .otherwise("answer").alias("name"),
        arguments.alias("arguments"), F.array(ident(2)).alias("depends_on"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", ident(1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


@query
def op3_chat_formatting(spark, sf_dir):
    calls, results = calls_and_results(table(spark, sf_dir, "conversations"))
    return chat.format_calls(calls, results, SCHEMAS).select(
        "conv_id", "call_id", "turn", "name", "position", "status",
        F.coalesce("result_turn", F.lit(-1)).alias("result_turn"), F.array_join("errors", "; ").alias("errors"), "valid", F.sha2("json", 256).alias("json_sha256"),
    )


_ORACLE["op3_chat_formatting"] = """
WITH calls AS (
    SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, coalesce(text, '') AS text,
           length(coalesce(text, '')) % 50 AS size_limit,
           CASE turn % 4 WHEN 3 THEN 'lookup' WHEN 2 THEN 'search' ELSE 'answer' END AS name,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position
    FROM conversations WHERE role = 'user'
), results AS (
    SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text
    FROM conversations WHERE role = 'assistant'
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
       c.turn, c.name, c.position,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered'
            ELSE 'linked' END AS status,
       coalesce(r.turn, -1) AS result_turn,
       CASE WHEN c.call_id IS NULL THEN NULL ELSE concat_ws('; ',
           CASE WHEN name <> 'lookup' AND size_limit > 40 THEN 'limit: above 40' END,
           CASE WHEN name = 'lookup' THEN 'name: unknown tool' END,
           CASE WHEN name <> 'lookup' AND length(c.text) > 400 THEN 'text: above 400' END,
           CASE WHEN name <> 'lookup' AND length(c.text) < 1 THEN 'text: below 1' END) END AS errors,
       coalesce(c.call_id IS NOT NULL AND r.call_id IS NOT NULL AND name <> 'lookup'
           AND size_limit <= 40 AND length(c.text) BETWEEN 1 AND 400, false) AS valid,
       sha256('{"arguments":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE '{' ||
                  CASE WHEN c.turn % 4 = 2 THEN '"exact":true,' ELSE '' END ||
                  '"limit":' || size_limit || ',"text":' || to_json(c.text)::VARCHAR || '}' END ||
              ',"id":' || to_json(coalesce(c.call_id, r.call_id))::VARCHAR ||
              ',"name":' || coalesce(to_json(name)::VARCHAR, 'null') ||
              ',"result":' || CASE WHEN r.text IS NULL THEN 'null' ELSE to_json(r.text)::VARCHAR END ||
              '}') AS json_sha256
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""


# --- 4: benchmark decontamination -----------------------------------------------


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.contamination(decontamination.find_matches(docs, benchmark))


@query
def op4_decontamination(spark, sf_dir):
    return contaminated(spark, table(spark, sf_dir, "documents"), sf_dir).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


# --- 5: MinHash near-dedup --------------------------------------------------------


@query
def op5_minhash_dedup(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.expr("doc_id <=> component_id").alias("kept"), "links",
    )


# --- 6: sharding ----------------------------------------------------------------


@query
def op6_sharding(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(text).alias("text_crc32")
    )
    return sharding.assign_shards(docs, 8, keep=("text_crc32",)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# CRC-32 as a fold over the bytes, with the table of its 256 one-byte remainders.
_CRC32 = """
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    )) AS t
)"""

_ORACLE["op6_sharding"] = f"""
WITH {_CRC32}, sized AS (
    SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT + 1 AS size
    FROM documents
), summed AS (
    SELECT doc_id, text, size,
           (sum(size) OVER (ORDER BY doc_id) - size)::BIGINT AS before,
           (sum(size) OVER ())::BIGINT AS total,
           row_number() OVER (ORDER BY doc_id) AS n
    FROM sized
), cut AS (
    SELECT *, least(7, (2 * before + size) * 8 // (2 * total))::INTEGER AS shard FROM summed
)
SELECT doc_id, size,
       xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(
               range(size - 1),
               lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])
       ))::BIGINT AS text_crc32,
       'bytes' AS law, shard,
       (n - min(n) OVER (PARTITION BY shard))::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM cut, crc_table
"""


# --- 7: suffix-array dedup ------------------------------------------------------


@query
def op7_suffix_dedup(spark, sf_dir):
    removed = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
    return repeats.dedup_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# --- 8: quality rules -----------------------------------------------------------


def quality_verdicts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_sample(table(spark, sf_dir, "labels"))
    return quality.verdicts(quality.quality_scores(docs, trusted))


@query
def op8_quality_rules(spark, sf_dir):
    return quality_verdicts(spark, table(spark, sf_dir, "documents"), sf_dir)


# --- 9: line dedup --------------------------------------------------------------


@query
def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return lines.dedup_lines(docs, equal_from=1).select(
        "doc_id", "removed_lines", F.octet_length(kept).cast("bigint").alias("n_bytes"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


# --- 10: toxicity ---------------------------------------------------------------


@query
def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    labelled = toxicity.labelled_sample(labels.where(~held_out))
    return toxicity.toxicity_scores(docs, labelled).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


# --- 11: fill-in-the-middle -------------------------------------------------------


@query
def op11_fill_in_middle(spark, sf_dir):
    outputs = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return outputs.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


_ORACLE["op11_fill_in_middle"] = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, len(units)::BIGINT AS n,
           ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS one,
           ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS two,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                     OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), cut AS (
    SELECT *, array_to_string(units[1:least(one, two)], '') AS prefix,
           array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(units[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


# --- 12: language-model scores ----------------------------------------------------


@query
def op12_interpolated_scores(spark, sf_dir):
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    docs = table(spark, sf_dir, "documents")
    return interpolation.interpolated_scores(docs, held_out=remainder == 2, deleted=remainder == 3)


# --- 13: filter interactions ------------------------------------------------------


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_ORACLE["op13_filter_audit"] = r"""
WITH found AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), failures AS (
    SELECT f.doc_id, part, map {
        'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
        'C': 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': doc_id > min(doc_id) OVER (PARTITION BY text)
    } AS fails
    FROM found f
), marked AS (
    SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM failures f LEFT JOIN (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ) l ON l.doc_id = f.doc_id
), cells AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM marked GROUP BY part, fails
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, s::INTEGER AS step, filter_order[s] AS own,
           string_split(filter_order[1:s - 1], '') AS before, string_split(filter_order, '') AS every
    FROM orders, range(1, 6) r(s)
), asked AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS own_fails,
           list_bool_or(list_transform(before, lambda x: x <> '' AND fails[x])) AS fell_before,
           list_sum(list_transform(every, lambda x: fails[x]::INTEGER)) AS failed
    FROM cells, steps
), counted AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT coalesce(fell_before, false) AND NOT own_fails), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (NOT coalesce(fell_before, false) AND own_fails), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (coalesce(fell_before, false) AND own_fails), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (own_fails AND failed = 1), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (NOT coalesce(fell_before, false) AND own_fails), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (NOT coalesce(fell_before, false) AND own_fails), 0)::BIGINT AS toxic_lost
    FROM asked GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
