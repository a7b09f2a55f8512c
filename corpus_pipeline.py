"""Corpus pipeline: five stages over documents, each written as Parquet and read again.

1. toxicity: documents that score 0.5 or more go;
2. line dedup: of every component of near-equal lines one line stays, documents without any line left go;
3. n-gram Jaccard join: one document of each group of near copies stays, the one with the smallest id;
4. benchmark decontamination: documents that hold passages of benchmark items go;
5. mixing: epochs and token-prefixes of the rest, by domain, language and source.

Stages 1 to 4 return the columns of documents (``n_chars`` counted anew where
lines went), stage 5 adds domain, epoch and tokens, in place of columns with
these names. Other columns beyond those of documents are passed on. Documents with a null id have no duplicates and no
overlaps: they stay in stages 2 to 4. Documents that share an id stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from dialtone.llm.common import stored, table
from dialtone.llm.queries import MIX_WEIGHTS, mix_domain


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=docs.columns).where("toxic_score < 0.5").drop("toxic_score")


def keep_first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(docs)
    counted = F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", counted).select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_join(docs)
    copies = stored(found.where("component_id <> doc_id").select("doc_id"), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ("domain", "epoch", "tokens")
    mixed = mixing.mix(docs, mix_domain(), MIX_WEIGHTS, name="__mix")
    return mixed.select(*[c for c in docs.columns if c not in added], *[f"__mix.{c}" for c in added])


STAGES = [
    ("toxicity", keep_civil),
    ("line_dedup", keep_first_lines),
    ("ngram_join", keep_first_copies),
    ("decontamination", keep_unleaked),
    ("mixing", mix_sources),
]

#: The first two stages can't be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
