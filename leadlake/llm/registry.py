"""The registered queries of this subpackage with their SQL oracles, and the corpus pipeline."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from leadlake.llm import chat, decontaminate, jaccard, licenses, merkle, oracles, packing, quality, repeats, secrets, sharding, tokens, toxicity, whitening
from leadlake.session import literal_rows

SHARDS = [f"shard-{n:02d}" for n in range(64)]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    wanted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("row.doc_id", *[F.col(f"quality.{c}").alias(c) for c in wanted])


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong spans of every document, and all spans with the linked weak ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, keep=["doc_id"])
    both = F.sort_array(F.concat("strong", "linked"))
    return found.select(
        "row.doc_id", *[secrets.count_of(F.col("strong"), k).alias(f"n_{k}") for k in secrets.STRONG],
        F.sha2(secrets.as_text(F.col("strong")), 256).alias("base_sha256"), secrets.as_text(both).alias("spans"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in every document."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = tokens.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that quotes control strings, formatted and read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    quoted = literal_rows(spark, "conv_id long,turn long,role string,text string",
                          [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(quoted)
    return chat.digests(chat.format_turns(turns))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with the edits between them."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "edits")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    placed = sharding.place(_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return placed.select("row.doc_id", "slot", "shard")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its long repeats, and the text left (a cut character shows as U+FFFD)."""
    cut = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and near-duplicate component."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack_documents(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op12_merkle_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and witness of every document, and whether the document as it is now still leads to the root."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(
        [*[F.col(c) for c in columns[:-1]], F.translate("text", string.ascii_uppercase, string.ascii_lowercase)]))
    checked = merkle.verify(merkle.leaves(docs, columns, "lang", "doc_id", tampered))
    return checked.select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the eight leading components. ``deviation`` is NULL only where no long can hold it;
    ``deviation_exact`` always holds it."""
    done = whitening.whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)
    return done.select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
        "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "pipeline": pipeline,
        "op1_quality_rules": op1_quality_rules,
        "op2_secret_scans": op2_secret_scans,
        "op3_license_scans": op3_license_scans,
        "op4_token_counts": op4_token_counts,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_benchmark_decontamination": op6_benchmark_decontamination,
        "op7_sharding": op7_sharding,
        "op8_suffix_array_dedup": op8_suffix_array_dedup,
        "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
        "op10_packing": op10_packing,
        "op11_toxicity": op11_toxicity,
        "op12_merkle_dataset_manifest": op12_merkle_dataset_manifest,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": oracles.QUALITY,
        "op2_secret_scans": oracles.SECRETS,
        "op5_chat_formatting": oracles.CHAT,
        "op7_sharding": oracles.sharding(SHARDS),
        "op12_merkle_dataset_manifest": oracles.MERKLE,
    }
