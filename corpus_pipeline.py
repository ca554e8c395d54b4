"""Corpus pipeline: toxicity, near duplicates, decontamination, mixing, token-ID output.

Each stage takes (spark, docs, sf_dir); docs is what the stage before kept, written as Parquet
and read again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.llm import decontaminate, mixing, packing, setsketch, toxicity
from keystrata.llm.common import cut, spread, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score under 0.5; the model learns from the labels of documents given.

    Null and empty texts score the model's bias and so stay where clean ones are the most; a score
    of 0.5 is toxic. Rows with null id are scored, never learnt from; repeated rows fare alike.
    Without labels all stay. An empty table gives an empty one; other columns than those of
    documents are left out.
    """
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model, COLUMNS, kept=True).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: five-word shingles, similarity 0.8.

    It is the row of smallest id (null last). Rows without words are in no group and stay; rows
    of one id with different texts are grouped by text, so those not linked stay, too. Rows
    alike in id and text are one group, of which the smallest in all columns stays.
    """
    found = cut(setsketch.near_duplicates(docs, width=5).where("group is not null").groupBy("id", "mark").agg(F.min("group").alias("group"), F.count("*").alias("rows")), most=docs.count())
    first = found.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "mark")).alias("first")).select("group", F.col("first.id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    judged = cut(spread(found, first, "group", F.struct("id", "mark")).select(F.col("id").alias("#id"), F.col("mark").alias("#mark"), "rows", (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))).alias("#stays")), most=found.count())
    marked = docs.select(*COLUMNS).withColumn("#own", F.xxhash64("text", F.lit(7)))
    same = F.col("doc_id").eqNullSafe(F.col("#id")) & (F.col("#own") == F.col("#mark"))
    left = marked.join(judged.where("not `#stays`").select("#id", "#mark"), same, "left_anti")
    twice = judged.where("`#stays` and rows > 1").select("#id", "#mark")
    if twice.isEmpty():
        return left.select(*COLUMNS)
    repeated = left.join(twice, same, "left_semi").groupBy("doc_id", "#own").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return left.join(twice, same, "left_anti").select(*COLUMNS).unionByName(repeated)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its edit budget, a distance of just the budget included.

    Null and empty texts hold nothing and stay; null, empty and blank items are in nothing. Repeated
    rows fare alike. An empty table gives an empty one, an empty benchmark drops nothing.
    """
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"), columns=COLUMNS, clean_only=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each whole or partial time a document is taken, n_chars made to fit.

    Null and empty texts have no words and are never taken; a null source is a source, the last.
    Rows whose keys tie go by id and size; repeated rows are rows each. An empty table gives an
    empty one.
    """
    mix = mixing.copies(mixing.mixed(docs.select(*COLUMNS)))
    return mix.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids of all texts; each row of docs has a number of its own in `texts`.

    Null and empty texts give no tokens; null ids stay null; repeated rows are packed each. Pieces of
    one length go in the order of docs. An empty table gives an empty one.
    """
    return packing.packed(docs)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("mixing", mixture), ("token_ids", tokens)]

#: A learnt model and a tokenizer decide: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two stages the rows are cut to the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
