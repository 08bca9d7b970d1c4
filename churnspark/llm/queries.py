"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm import (
    alignment,
    chat_format,
    class_model,
    fingerprints,
    kneser_ney,
    language_id,
    line_dedup,
    mixing,
    page_text,
    quality_rules,
    whitening,
)
from churnspark.llm.near_dedup import near_duplicates
from churnspark.llm.oracles import oracle_sql
from churnspark.llm.packing import pack_documents
from churnspark.runtime import materialize

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters that 3 documents share, kept in the last of them only."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    marked = line_dedup.with_bitmaps(docs, line_dedup.line_keep_bitmaps(docs))
    return marked.select(
        "doc_id",
        line_dedup.line_count(F.col("text")).alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(line_dedup.kept_text(F.col("text"), F.col("__keep")), 256).alias("kept_sha256"),
    )


def _fold(identifier: str, parts: int) -> Column:
    """Fold of an id by the checksum of its text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(identifier).cast("string"), F.lit(""))) % parts


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from the documents of three folds out of four."""
    docs = _documents(spark, sf_dir)
    model = language_id.train(docs.where(_fold("doc_id", 4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every text under a model of the documents labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return kneser_ney.classify(_documents(spark, sf_dir), labels)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text and of its edited text, with their likeness."""
    pairs = fingerprints.edited_pairs(_documents(spark, sf_dir))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that imitates control strings, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    rows = rows.unionByName(planted).withColumn("parts", chat_format.text_parts(F.col("text")))
    chats = chat_format.format_chats(rows)
    turns = chat_format.read_turns(F.col("formatted"))
    line = F.lit("\n")
    chats = chats.withColumn("turns", turns).withColumn(
        "loss", chat_format.read_loss_text(F.col("formatted"), F.col("loss_spans"))
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the queries; the byte-level BPE one by default."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of at most 1024 tokens."""
    _, places = pack_documents(_documents(spark, sf_dir), tokenizer_path(), end_id=2)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram score of every text, learned from the documents of four folds out of five."""
    docs = _documents(spark, sf_dir).withColumn("train", _fold("doc_id", 5) != 1)
    scored = class_model.score_texts(docs.select("doc_id", "text", "train"), "train")
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 5, 2, 1 to 150 % of all words, none above twice its own."""
    mixed = mixing.mixture(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share at least 80 % of their distinct 4-word shingles."""
    return near_duplicates(_documents(spark, sf_dir), width=4, percent=80)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, base rules and the verdict of a decision list learned from all labels."""
    counted = materialize(quality_rules.with_statistics(_documents(spark, sf_dir)), "statistics")
    rules = quality_rules.train_rules(counted, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(counted, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_distinct_words", "n_upper", "n_digits", "n_marks",
    )


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by differencing it with the pages next to it in its host."""
    found = page_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_lines", "n_shared", "n_deleted"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers in every text, scored by the corpus-wide counts of their pairs."""
    docs, _ = alignment.align(_documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return docs


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings, whitened by their eight leading components."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_language_id": op2_language_id,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_fingerprints": op4_fingerprints,
        "op5_chat_format": op5_chat_format,
        "op6_near_dedup": op6_near_dedup,
        "op7_packing": op7_packing,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_mixing": op9_mixing,
        "op10_quality_rules": op10_quality_rules,
        "op11_page_text": op11_page_text,
        "op12_alignment": op12_alignment,
        "op13_whitening": op13_whitening,
    }
