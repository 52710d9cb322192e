"""The ``opN_<name>`` queries over the driver tables and their DuckDB SQL.

A query applies one operator, with production parameters, to its whole table and derives
the digest columns of its result.  ``ORACLES`` has the SQL where SQL can state it; the
others are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bagminhash,
    byte_bpe,
    importance_resampling,
    line_blocks,
    minimax_shards,
    periodic_runs,
    perspective_chat,
    radix_dedup,
    recurrent_lm,
    separator_scan,
    source_mixing,
    token_alignment,
    wu_manber,
)
from .shared import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def rank_file() -> str:
    return public_tokenizers.path(byte_bpe.RANKS)


@register
def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.count_tokens(table(spark, sf_dir, "documents"), rank_file())


@register
def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


@register
def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("uid")


@register
def op4_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = line_blocks.extract_main_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@register
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_round_trip(table(spark, sf_dir, "documents"), rank_file())


@register
def op6_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return wu_manber.contamination(wu_manber.find_windows(docs, items))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)

ORACLES["op6_wu_manber"] = f"""
WITH it AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM it WHERE len(w) > 0)
),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS win
  FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
    FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size
  )
),
hits AS (SELECT doc_id, k, dw.size, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.win = iw.win),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN hit_words USING (doc_id)
"""


@register
def op7_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = minimax_shards.minimax_shards(table(spark, sf_dir, "documents"), shards=8)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op8_perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = perspective_chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    return each.withColumn("mask", perspective_chat.mask_text())


ORACLES["op8_perspective_chat"] = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         CAST(coalesce(floor(turn / {perspective_chat.PART_TURNS}.0), -1) AS BIGINT) AS part
  FROM conversations
),
j AS (
  SELECT r.*, speaker, role = speaker AS own,
         '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
                                ELSE 'user name=' || role END || chr(10) AS head
  FROM r JOIN (SELECT DISTINCT conv_id, role AS speaker FROM r WHERE role <> 'system') USING (conv_id)
),
k AS (
  SELECT *, sum(length(head) + length(text) + 11) OVER w - length(text) - 11 AS pos,
         row_number() OVER w AS k
  FROM j
  WINDOW w AS (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, speaker, part, count(*) AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(pos + length(text) AS BIGINT) AS VARCHAR), ','
                           ORDER BY k) FILTER (WHERE own), '') AS mask
FROM k GROUP BY conv_id, speaker, part
"""


@register
def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = importance_resampling.fit(docs, table(spark, sf_dir, "labels"))
    return importance_resampling.gumbel_top(written(importance_resampling.score(docs, model), "weights"))


@register
def op10_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.radix_groups(table(spark, sf_dir, "documents")).drop("row")


ORACLES["op10_radix_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
"""


def planted_repeats():
    """The text of every tenth document (by hash) with its words from one on in a period."""
    words = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, w = F.floor(h / 10), F.expr(words)
    n = F.size(w)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))
    turned = F.concat(F.slice(w, F.lit(1), a), F.slice(F.flatten(block), F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(turned, " ")).otherwise(F.col("text"))


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_repeats().alias("text"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # runs come by start, then period, so the first of the greatest stays
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    found = periodic_runs.periodic_runs(docs).withColumn("best", best)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = (token_alignment.BYTE_MODEL, token_alignment.PIECE_MODEL)
    return token_alignment.alignment_counts(table(spark, sf_dir, "documents"), tuple(map(public_tokenizers.path, models)))


@register
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


ORACLES["op13_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15)
              AS BIGINT) AS key
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
),
r AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, cap / weight AS ratio,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source) AS k FROM s
),
-- the level at which the first k sources are full, for every k
l AS (
  SELECT k, (1.5::DOUBLE * t - full_cap) / (w - full_weight) AS level, ratio
  FROM (
    SELECT k, ratio, CAST(sum(source_size) OVER () AS BIGINT) AS t, CAST(sum(weight) OVER () AS BIGINT) AS w,
           sum(cap) OVER o - cap AS full_cap, CAST(sum(weight) OVER o - weight AS BIGINT) AS full_weight
    FROM r WINDOW o AS (ORDER BY k ROWS UNBOUNDED PRECEDING)
  )
),
level AS (SELECT arg_min(level, k) AS level FROM l WHERE ratio > level),
t AS (SELECT r.*, least(cap, coalesce(level, 0) * weight) AS target FROM r, level),
b AS (
  SELECT *, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t
),
p AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size
                                 ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
  FROM d
)
SELECT p.doc_id, p.size, b.source_size, b.target,
       b.epochs * p.size + greatest(0, least(p.size, b.budget - b.epochs * b.source_size - p.start)) AS taken,
       p.source, b.epochs
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
