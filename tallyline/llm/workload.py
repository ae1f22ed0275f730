"""Queries of the subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Staging
from . import (
    alignment, archives, chat, decontaminate, language_model, line_dedup, mixing, near_dedup, nearest, packing,
    prefix_trie, quality, substring_dedup,
)

# The conversation that op1 adds: a user, then an assistant row, both saying this.
EXTRA_ID, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"),
    )
    done = chat.format_threads(chat.threads_of(rows.unionByName(extra)))
    read = done.select(
        F.col("tree").alias("conv_id"), "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents")).drop("version")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_table(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark, "warc")
    folder = staging.folder("archives")
    archives.write_archives(_read(spark, sf_dir, "pages"), folder)
    return archives.resolved_records(staging, archives.read_archives(spark, folder))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return quality.Resampler(docs, labels, drop_toxic=True).decisions()


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")

    def held_out(doc_id):
        return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2

    scored = language_model.score_documents(docs, ~held_out(F.col("doc_id")), order=3)
    return scored.withColumn("held_out", held_out(F.col("doc_id")))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixture_plan(_read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op10_single_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier name of the same rule, of which op10_line_dedup once kept a part only."""
    return op10_line_dedup(spark, sf_dir)


def _vocabulary(name: str) -> str:
    """The installed place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return alignment.Alignment(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model")).documents()


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.PrefixTrie(prefix_trie.rebuilt_turns(_read(spark, sf_dir, "conversations"))).rows()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat, op2_near_dedup, op3_decontaminate, op4_warc, op5_quality, op6_substrings, op7_language_model,
        op8_nearest, op9_mixing, op10_line_dedup, op10_single_lines, op11_packing, op12_alignment,
        op13_prefix_trie,
    )
}
