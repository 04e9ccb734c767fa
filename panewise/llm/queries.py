"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.llm import (
    decontamination,
    kneser_ney,
    language,
    lattice,
    merkle,
    oracles,
    packing,
    page_text,
    pii,
    preferences,
    prefix_trie,
    rules,
    simhash,
    substrings,
)
from panewise.llm.tables import fold
from panewise.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n_points", F.exp("log_perplexity").alias("perplexity"), "kept")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = lattice.score(docs, fold("doc_id", 5) != 1, public_tokenizers.path("piece_bpe_32k.model"))
    held_out = F.coalesce(fold("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(name: str) -> Column:
        parts = F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    found = pii.detect(table(spark, sf_dir, "documents"))
    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, ranks, public_tokenizers.PATTERN)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, fold("doc_id", 3) != 1)
    held_out = (fold("doc_id", 3) == 1).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no preferences: of two neighbours, the conversation with the even number is the chosen one.
    pairs = preferences.preference_pairs(
        table(spark, sf_dir, "conversations"), F.shiftright("conv_id", 1), F.col("conv_id").bitwiseAND(1) == 0
    )
    digest = {name: F.array_join(name, "") for name in ("chosen", "rejected")}
    masks = {name: F.array_join(F.col(name).cast("array<string>"), "") for name in ("chosen_mask", "rejected_mask")}
    return pairs.withColumns(digest | masks)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.isolation_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "anomaly")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    return prefix_trie.prefix_trie(prefix_trie.with_borrowed_start(turns, conv_id - conv_id % 20, fold("conv_id", 4)))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    one_more = F.when(fold("doc_id", 7) == 0, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed={"n_chars": one_more})
    folded = found.withColumn("folded_root", merkle.fold(F.col("changed_leaf"), F.col("steps")))
    proof = merkle.proof_digest(F.col("steps")).alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return folded.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", verified)


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.page_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


QUERIES: dict[str, Query] = {
    "op6_pii": op6_pii,
    "op2_quality": op2_quality,
    "op4_lattice": op4_lattice,
    "op3_substrings": op3_substrings,
    "op1_decontamination": op1_decontamination,
    "op8_language": op8_language,
    "op10_preferences": op10_preferences,
    "op5_simhash": op5_simhash,
    "op9_quality_rules": op9_quality_rules,
    "op7_packing": op7_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_page_text": op13_page_text,
}
ORACLES: dict[str, str] = {
    "op1_decontamination": oracles.DECONTAMINATION,
    "op10_preferences": oracles.PREFERENCES,
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op12_merkle": oracles.MERKLE,
}
