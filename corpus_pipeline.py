"""From documents to token files.

The stages, each ``(spark, docs, sf_dir) -> DataFrame`` over all that the one before kept:

1. quality rules: documents that fail a rule, or whose host is rejected, go;
2. near duplicates: of documents that similarity links connect, the one of least doc_id stays;
3. decontamination: passages of the benchmark are cut from the texts; a document that has nothing else goes;
4. mixing: documents are repeated or left out as the target weights ask, in training order;
5. token ids: every row is encoded and written in training order (the order in which the table of stage 4 was
   written); the rows read back from the files are returned, their ``start`` ascends in that order.

Null doc_ids and texts are borne as the operators say; extra columns travel along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontaminate, mixing, nearjoin, quality, tokens
from tidepool.llm.common import read
from tidepool.llm.queries import END_ID, tokenizer_path
from tidepool.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The row travels as one column, so that no column of it can clash with the rules'.
    scored = quality.score(docs.select(F.struct(*docs.columns).alias("_row"), "source", "text"))
    judged = quality.judge(scored, quality.host_rates(scored, "source"), "source")
    # A filter on a row number stays above the rules; pushed below them, it would repeat their expressions.
    judged = judged.withColumn("_nth", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("_nth") >= 0)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each class of similar documents (see ``first_of_class``)."""
    return nearjoin.first_of_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Texts reach Python once: the rest of the row travels without its text, which comes back as the clean one.
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("_row"), F.col("text").isNull().alias("_null"), "text")
    found = decontaminate.scan(rows, read(spark, sf_dir, "benchmark"), keep=["_row", "_null"], clean=True)
    hit = F.col("_found.n_hit") > 0
    left = found.filter(~hit | (F.col("_found.n_hit") < F.col("_found.n_words")))
    changed = {"text": F.when(~F.col("_null"), F.col("_clean")),
               "n_chars": F.when(hit, F.length("_clean").cast("long")).otherwise(F.col("_row.n_chars"))}
    return left.select(*((changed[c] if c in changed else F.col("_row")[c]).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs, mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files are in the order of the table before, the training order."""
    # The workers have grown in earlier stages: a small memory of words, given up after each task.
    folder = tokens.encode(docs, tokenizer_path(), END_ID, order=tokens.as_written(), word_memory=32 << 20, keep_memory=False,
                           slice_chars=1 << 20)
    return tokens.decode(spark, folder)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_ids),
]

ORACLE_SQL = None  # the tokenizer's ids are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
