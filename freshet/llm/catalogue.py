"""One query per operator: the operator on its whole table, with the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, jaccard_join, language_mixture, line_dedup, lm_score, merkle, mil_quality, mixing, oracle, packing, pii,
    quality_rules, secret_scan, spelling,
)
from .textarrays import crc32_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def count_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_words_left",
    )


@query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets found in every document."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", count_of("assign"), count_of("access"), count_of("hex"),
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )




@query()
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    taken, _ = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and where."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data found in every document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    return found.select(
        "doc_id", *[count_of(kind) for kind in pii.BASE_KINDS],
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = crc32_mod("doc_id", 5)
    model = language_mixture.learn(docs.filter(rest != 0))
    found = language_mixture.identify(docs.select("doc_id", "text", F.coalesce(rest == 0, F.lit(False)).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("languages").alias("n_languages"))


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = crc32_mod("doc_id", 4)
    labels = table(spark, sf_dir, "labels").filter(rest != 2).select("doc_id", F.col("quality").alias("label"))
    found = mil_quality.score(docs, mil_quality.learn(docs, labels))
    return found.select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query()
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that another document, or the same one before, has alike."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return lm_score.score_documents(docs.select(
        "doc_id", "text", F.coalesce(code % 7 != 2, F.lit(False)).alias("training"),
        F.coalesce(code % 7 == 2, F.lit(False)).alias("held_out"), F.floor(code / 7).alias("part"),
    ))


@query(oracle.MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a possibly changed document still folds to the root.

    A document without an id is not changed.
    """
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = merkle.row_digest(*fields)
    changed = merkle.row_digest("doc_id", "source", "lang", F.col("n_chars") + 1, "text")
    rows = docs.select(*fields, F.when(crc32_mod("doc_id", 7) == 0, changed).alias("changed"))
    found = merkle.manifest(rows, leaf, "lang", "doc_id", ["doc_id", "changed"])
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query()
def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece of every document and its place in a sequence of 4096 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, 1)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 4096)


@query(oracle.SPELLING)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word; runs in a document without an id lose no letter."""
    runs = spelling.runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    code = F.crc32(F.concat(F.col("row.doc_id").cast("string"), F.lit(":"), "run").cast("binary"))
    words = runs.select(spelling.dropped_letter(F.col("run"), code, 199).alias("word"))
    return spelling.group_variants(spelling.word_counts(words, "word", 6, 5))
