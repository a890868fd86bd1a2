"""Registered queries of the subpackage: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.ball_tree import scaled, top_k
from clickweave.llm.conversation_repair import conversation_report, damage, repair, turn_dice
from clickweave.llm.fill_middle import fill_in_middle, restored
from clickweave.llm.hyperlang import identify
from clickweave.llm.latent import contaminated
from clickweave.llm.lm_scoring import score
from clickweave.llm.main_text import extract_main_text
from clickweave.llm.mixing import mix
from clickweave.llm.relative_lz import remove_copied
from clickweave.llm.secret_scan import BASE, find_secrets, listed
from clickweave.llm.simhash import simhash_groups
from clickweave.llm.suffix_array import repeated_passages
from clickweave.llm.token_store import token_output

TOKENIZER_FILE = "byte_bpe_50k.json"
TOKENIZER_IDS = 50_257


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v"))
    return top_k(rows, F.col("vec_id") % 50 == 0, 5)


def op2_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("row")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_FILE))


def op3_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_read(spark, sf_dir, "documents"), tokenizer_path())


def op4_hyperlang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_read(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(_read(spark, sf_dir, "documents"), tokenizer_path(), TOKENIZER_IDS)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_read(spark, sf_dir, "pages"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_read(spark, sf_dir, "documents")).drop("row")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents")).drop("row")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_read(spark, sf_dir, "documents")).drop("row")


def op10_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_copied(_read(spark, sf_dir, "documents"), with_text=False).drop("spans", "kept")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_read(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, rate=100, spm_rate=50)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_trigram_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [rule.kind for rule in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(listed(F.col("spans"), kinds), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_edit_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_report(rows, repair(damage(rows, turn_dice(20))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ball_tree": op1_ball_tree,
    "op2_latent": op2_latent,
    "op3_attention": op3_attention,
    "op4_hyperlang": op4_hyperlang,
    "op5_token_store": op5_token_store,
    "op6_main_text": op6_main_text,
    "op7_suffix_array": op7_suffix_array,
    "op8_mixing": op8_mixing,
    "op10_relative_lz": op10_relative_lz,
    "op9_simhash": op9_simhash,
    "op11_fill_middle": op11_fill_middle,
    "op12_trigram_scan": op12_trigram_scan,
    "op13_edit_lattice": op13_edit_lattice,
}

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (
  SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS lines, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
         ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
c AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS a,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
         array_to_string(lines[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""

ORACLE_SQL: dict[str, str] = {
    "op1_ball_tree": OP1_SQL,
    "op11_fill_middle": OP11_SQL,
}
