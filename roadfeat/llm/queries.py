"""The registered queries of this subpackage; each is a thin view of its operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadfeat.llm import divergence as terms
from roadfeat.llm import embedding_dedup as graph
from roadfeat.llm import line_rules as rules
from roadfeat.llm.language import languages
from roadfeat.llm.lm_scoring import loss_differences
from roadfeat.llm.merkle import build_manifest, merkle_oracle, tampered_text
from roadfeat.llm.mixing import mix
from roadfeat.llm.packing import pack
from roadfeat.llm.quality import quality_scores
from roadfeat.llm.sharding import Topology, digest, sharding_oracle, write_shards
from roadfeat.llm.simhash import simhash_groups
from roadfeat.llm.suffix_dedup import suffix_dedup
from roadfeat.llm.token_shards import shard_digests, write_token_shards

#: A document is predicted to be good from this score.
GOOD_FROM = 0.3
#: Eight shards of equal weight in two regions of two racks each.
TOPOLOGY = Topology.even(regions=2, racks=2, shards=2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, read back from the shards by key."""
    docs = table(spark, sf_dir, "documents")
    return shard_digests(write_token_shards(docs, tokenizer("byte_bpe_50k.json"), end_id=0))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return graph.embedding_groups(table(spark, sf_dir, "embeddings"), least=0.98)


def op3_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and the sequence it fills."""
    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2).drop("ids")


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return rules.line_rules(table(spark, sf_dir, "documents")).drop("text_hash", "n_removed_words", "removed_lines")


def op5_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more every document is like those labelled good than like all."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return loss_differences(table(spark, sf_dir, "documents"), good)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix(table(spark, sf_dir, "documents")).digest()


def op7_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return languages(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings that occur twice."""
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op9_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash_groups(table(spark, sf_dir, "documents"), width=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document as read back from the shards, and its shard if there is one more."""
    return digest(write_shards(table(spark, sf_dir, "documents"), TOPOLOGY, TOPOLOGY.grown()).rows)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of every source to the others of its language, and the terms that set it apart."""
    return terms.report(terms.divergence(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verdict; half of the documents are verified with a changed text."""
    return build_manifest(table(spark, sf_dir, "documents"), tampered_text()).verify()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": op1_token_shards,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_binary_packing": op3_binary_packing,
    "op4_line_frequency": op4_line_frequency,
    "op5_cross_entropy": op5_cross_entropy,
    "op6_mixing": op6_mixing,
    "op7_rank_order_language": op7_rank_order_language,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quadratic_discriminant": op9_quadratic_discriminant,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_hash_tree_sharding": op11_hash_tree_sharding,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op2_embedding_dedup": graph.ORACLE,
    "op4_line_frequency": rules.ORACLE,
    "op11_hash_tree_sharding": sharding_oracle(TOPOLOGY, TOPOLOGY.grown()),
    "op12_source_divergence": terms.ORACLE,
    "op13_merkle_manifest": merkle_oracle(),
}
