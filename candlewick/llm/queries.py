"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise, scratch_path

from . import (
    bpe,
    embedding_dedup,
    license_scan,
    merkle,
    mixing,
    packing,
    passage_dedup,
    prefix_trie,
    quality,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from .common import table

#: Name of the vocabulary file, found by the installed package of public tokenizers.
VOCABULARY = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", F.col("html").alias("payload"))
    files = materialise(warc.write(warc.mark_revisits(pages), scratch_path(spark, "warc")), "warc-files")
    listed = materialise(warc.index(files), "warc-index")
    read = materialise(warc.measured(warc.read(listed)), "warc-records")
    return warc.resolved(read).select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary_path()
    encoded = bpe.encode(table(spark, folder, "documents"), path, keep=["doc_id"], decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = materialise(docs.select("doc_id", "source", mixing.word_count("text").alias("size")), "document-sizes")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.plan(sized).select("doc_id", "size", "source_size", "target", taken)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), keep=["doc_id"])


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find(table(spark, folder, "documents"))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in ("assign", "access", "hex")],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passage_dedup.find(table(spark, folder, "documents"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.find(table(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    measured = materialise(quality.measure(docs, keep=["doc_id", "lang"]), "quality-measures")
    judged = quality.judge(measured, table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), vocabulary_path(), keep=["doc_id"])
    cut = cut.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")
    return packing.place(materialise(cut, "packing-pieces"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = [merkle.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.when(changed, merkle.leaf_digest(fields))
    proofs = merkle.Manifest(docs, keep=["doc_id"], extra={"tampered": tampered}).proofs()
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = materialise(prefix_trie.ordered_turns(table(spark, folder, "conversations")), "ordered-turns")
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_sharding": op4_sharding,
    "op5_secrets": op5_secrets,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_passages": op7_passages,
    "op8_licenses": op8_licenses,
    "op9_simhash": op9_simhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_packing": op11_packing,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
}
