"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, token ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``, gets all rows that the stage before
kept, and returns the columns of documents (the last one: token ids and their decoded text).
``run`` writes every stage to shared storage and rereads it as the next one's input, so
a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import anchors, pivots, rankarray, softmix, thresholds
from starling.llm.common import prepare, stage, table

# target shares of tokens, of the domains that the stage's input holds, and of the corpus's
# tokens in all; only documents toxic at least with the probability CLEARLY may go
SHARES = {"good": 0.96, "poor": 0.03, "toxic": 0.01}
BUDGET = 1.25
CLEARLY = 0.9


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the threshold table."""
    return thresholds.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    prepare(spark)
    return pivots.keep_one(docs, shingle=3, limit=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by marks; the character count follows the text."""
    prepare(spark)
    return anchors.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by rates that bring domain totals close to the target weights.

    Every document that is not clearly toxic has one copy at least, also where that
    keeps the totals away from the targets.
    """
    labelled = softmix.domains_of(table(spark, sf_dir, "labels"))
    model = softmix.fit_words(docs, labelled, softmix.DOMAINS)
    toxic = model.domains.index("toxic") if "toxic" in model.domains else None

    def floor(p):
        return F.lit(True) if toxic is None else F.get(p, toxic) < CLEARLY

    return softmix.mix(docs, model, [SHARES[d] for d in model.domains], BUDGET, floor=floor)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text they decode to."""
    prepare(spark)
    return rankarray.encode(docs.select("doc_id", "source", "lang", "text"), with_decoded=True).drop("text")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("source_mixing", source_mixing), ("token_ids", token_ids)]

# fingerprint components and fitted mixing rates have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage_function in STAGES:
        docs = stage(stage_function(spark, docs, sf_dir), name)
    return docs
