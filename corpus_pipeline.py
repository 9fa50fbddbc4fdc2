"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage but the last returns the columns of `documents`.  run() writes between stages under
spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import bpe, decontaminate, jaccard, language, substrings
from tillwatch.llm.queries import table, tokenizer_path
from tillwatch.llm.shared import small, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CARRY = ["lang", "source", "n_chars"]


def _columns(found: DataFrame) -> DataFrame:
    """The columns of documents again, with the length of the text as it is now."""
    return found.select("doc_id", "text", "rest.lang", "rest.source", F.length("text").cast("long").alias("n_chars"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages (no text, or no letter in it) go."""
    found = language.predict_language(docs, language.learn_profiles(docs), carry=CARRY)
    return found.filter("lang_pred != 'und'").select("doc_id", "text", "rest.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, the smallest id; of rows that repeat an id the one with the
    smallest digest of its text (then the smallest other columns) stays.  Rows without an id stay, all of them.

    No links in an empty table; other columns than those of documents do not come through.
    """
    docs = docs.select(COLUMNS)
    found = stored(jaccard.similar_documents(docs), "groups")
    gone = stored(found.filter("doc_id != component_id").select("doc_id").distinct(), "gone")
    kept = docs.join(small(gone), "doc_id", "left_anti")
    repeated = stored(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        twice = kept.join(small(repeated), "doc_id", "left_semi").withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
        rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
        # digests meet first, so that no texts of one id are gathered
        least = twice.groupBy("doc_id").agg(F.min(F.struct("digest", *rest)).alias("least"))
        same = [twice[c].eqNullSafe(F.col(f"least.{c}")) for c in ("digest", *rest)]
        twice = twice.join(least.withColumnRenamed("doc_id", "id"), (F.col("doc_id") == F.col("id")) & same[0] & same[1] & same[2] & same[3])
        twice = twice.select(COLUMNS).dropDuplicates(["doc_id"])
        kept = kept.join(small(repeated), "doc_id", "left_anti").unionByName(twice)
    return kept.select(COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand earlier are cut out; documents with nothing else go."""
    found = substrings.dedup_substrings(docs, carry=CARRY)
    return _columns(found.filter("n_removed < n_words or n_words = 0"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return _columns(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=CARRY))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, and the text decoded from them."""
    found = bpe.encode_documents(docs, tokenizer_path(), carry=CARRY)
    return found.select("doc_id", F.col("decoded").alias("text"), "rest.*", "n_tokens", "ids")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", remove_benchmark),
    ("bpe", encode),
]

#: language profiles and BPE have no SQL form; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
