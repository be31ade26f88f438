"""Registered queries of the subpackage: name -> callable(spark, source folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from atende.llm.best_fit_packing import best_fit_packing
from atende.llm.decontamination import decontaminate
from atende.llm.embedding_dedup import embedding_dedup
from atende.llm.embedding_whitening import whiten
from atende.llm.html_text import html_text
from atende.llm.license_scan import license_scan
from atende.llm.line_dedup import line_dedup
from atende.llm.piece_sampling import sample_pieces
from atende.llm.quality_rules import quality_rules
from atende.llm.simhash_dedup import simhash_components
from atende.llm.suffix_dedup import suffix_dedup
from atende.llm.token_alignment import alignment_counts
from atende.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of the line-first rules for every document."""
    return quality_rules(_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "q.kept"
    )


def op2_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sampled segmentations of every turn of the conversations; the ids as their checksum."""
    return sample_pieces(_table(spark, sf_dir, "conversations"), ["conv_id", "turn"]).drop("ids")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a training sequence."""
    return best_fit_packing(_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages."""
    return suffix_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "r.n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256", "r.kept_text"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many went, and the digest of what is left."""
    kept = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "r.n_lines", "r.n_removed", F.length("r.kept_text").cast("long").alias("kept_chars"), F.sha2("r.kept_text", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits that its id and text decide."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    at = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.length("text") + 1).cast("int")
    edit = lambda k, remove, insert: F.struct(at(k).alias("at"), F.lit(remove).alias("remove"), insert.alias("insert"))
    edits = F.array(edit(1, 40, F.lit("")), edit(2, 0, F.substr("text", at(3), F.lit(60))), edit(4, 12, F.substr("text", at(5), F.lit(12))))
    return token_counts(docs.withColumn("edits", F.when(F.col("text").isNotNull(), edits)))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text(_table(spark, sf_dir, "pages").select("page_id", "html")).select(
        "row.page_id", F.length("visible_text").cast("long").alias("n_chars"), "visible_text"
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, as a file of its source and language, a thousand documents a folder."""
    docs = _table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    return license_scan(docs.select(F.concat_ws("/", folder, F.concat("doc_id", F.lit(".txt"))).alias("path"), "text"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and which items those are."""
    found = decontaminate(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    items = F.col("d.items")
    return found.select(
        "row.doc_id", "d.n_words", "d.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("d.n_hit") > 0).alias("contaminated"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of the tokens that two tokenizers cut every document into, with corpus-wide counts."""
    return alignment_counts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "*").drop("row")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector."""
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_piece_sampling, op3_best_fit_packing, op4_suffix_dedup, op5_line_dedup, op6_token_counts,
        op7_html_text, op8_embedding_dedup, op9_license_scan, op10_simhash_dedup, op11_decontamination,
        op12_token_alignment, op13_embedding_whitening,
    )
}
