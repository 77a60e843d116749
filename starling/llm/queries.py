"""The registered queries of the LLM operators: thin, whole-table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import (anchors, bitplanes, brown, chains, extshuffle, graphparts, licenses, merkle, pivots, rankarray,
                          runs, softmix, thresholds)
from starling.llm.common import lower_ascii, prepare, scratch, table
from starling.llm.license_rules import QUERY_RULES


def op1_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as bit-plane files and read back."""
    docs, folder = table(prepare(spark), sf_dir, "documents"), bitplanes.new_folder(spark)
    return bitplanes.read_ids(bitplanes.write_ids(docs, folder), folder)


def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram scores of all texts, learned from nine tenths of them."""
    return brown.score(table(prepare(spark), sf_dir, "documents"))


def op3_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of low quality and, given it, of toxicity for every document."""
    docs, labels = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    given = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = chains.train(docs, given, ["low_quality", "toxic"])
    p = F.col("p")
    return chains.score(docs, chain).select("doc_id", p[0].alias("p_low_quality"), p[1].alias("p_toxic"),
                                            (p[0] > 0.5).alias("low_quality"), (p[1] > 0.5).alias("toxic"))


def op4_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; digests of both."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    coded = rankarray.encode(docs, with_decoded=True)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and the groups they link into."""
    found = pivots.cluster(table(prepare(spark), sf_dir, "documents"), shingle=3, limit=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and a digest of the base spans, and all spans."""
    found = anchors.detect(table(prepare(spark), sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*anchors.BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in anchors.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into eight shards."""
    docs = table(prepare(spark), sf_dir, "documents")
    done = extshuffle.write_shards(docs, scratch(spark, "shards"))
    return done.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                       F.col("slot").cast("long").alias("slot"), "grown_shard", "bucket")


def op8_threshold_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return thresholds.assess(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_stop_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op9_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rates whose expected domain totals match the target weights."""
    docs, labels = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = softmix.fit_domains(docs, softmix.domains_of(labels), softmix.DOMAINS)
    found = softmix.rates(docs, model, MIX_SHARES)
    return found.select("doc_id", "n_tokens", *[F.get("p", i).alias(f"p_{d}") for i, d in enumerate(softmix.DOMAINS)],
                        "rate", "copies", "targets", "reached")


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th vector."""
    rows = table(prepare(spark), sf_dir, "embeddings")
    return graphparts.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def op11_merkle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots, root and proofs of all documents, and a check of a tampered copy."""
    docs = table(prepare(spark), sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], altered={"text": text})
    return (found.withColumn("folded_root", merkle.fold(F.col("altered_leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, every tenth document with a repeated tail."""
    found = runs.detect(table(prepare(spark), sf_dir, "documents"), rewrite=runs.repeat_tail)
    best = runs.longest(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every text."""
    found = licenses.scan(table(prepare(spark), sf_dir, "documents"), rules=QUERY_RULES)
    return licenses.report(found, licenses.QUERY_PLACES)


# target shares of tokens of the domains good, poor and toxic
MIX_SHARES = [0.90, 0.07, 0.03]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bit_planes, op2_brown_classes, op3_classifier_chain, op4_rank_array_bpe, op5_pivot_simhash, op6_anchor_pii,
    op7_external_shuffle, op8_threshold_rules, op9_soft_mix, op10_learned_partitions, op11_merkle_rollup,
    op12_periodic_runs, op13_license_rules)}
