"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor
kept; ``run`` writes what a stage returns as Parquet and reads it again for the next.
All stages but the last return the columns of ``documents``.

- language: documents without a language (no text, or no letter in it) go; a missing
  label is filled with the predicted one, or stays null if no label can be learned.
- near_duplicates: of each group of documents linked by a Jaccard similarity of 0.8 over
  five-word shingles, the one with the least id stays (null comes last); of rows that
  repeat an id, each is a document of its own unless its text repeats as well.
- benchmark: documents that hold 0.8 of the shingles of a benchmark item go.
- personal_data: spans are replaced by their kind in brackets; n_chars follows the text.
- tokens: the ids of each text and the text decoded from them.

The model of the first stage, the labels of the fourth and the ids of the last have no
form in SQL, so that there is none for ``run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.llm import bpe, decontam, jaccard_join, langid, pii
from tidelake.llm.tables import ROW, row_hash, sieve_pages, table, with_sieve, written
from tidelake.session import new_folder

# Whether a row may go or repeat, and whether it may stay.
_OPEN, _KEPT = "_open", "_kept"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.model_of(docs)
    if model is None:  # no label to learn from
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, model)
    kept = found.filter(F.col("lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # By row, as ids may be null or repeat; rows that repeat an id and a text are copies.
    rows = docs.withColumn(ROW, row_hash("doc_id", "text"))
    joined = jaccard_join.join(rows, key=ROW).distinct()
    known = rows.groupBy(F.col(ROW).alias("doc_id")).agg(F.min("doc_id").alias("of"), F.count(F.lit(1)).alias("times"))
    named = written(joined.join(known, "doc_id"), "named")
    # Known ids come before null.
    order = F.struct(F.col("of").isNull().alias("last"), "of", "doc_id")
    least = named.groupBy("component_id").agg(F.min(order).alias("least"))
    kept = written(least.select(F.col("least.doc_id").alias(ROW)), "kept")
    repeated = named.filter("times > 1").select(F.col("doc_id").alias(ROW))
    open_rows = named.select(F.col("doc_id").alias(ROW)).join(kept, ROW, "left_anti").union(repeated)
    # A row in no sieve of what goes or repeats stays; texts are shuffled only of those that
    # are in it and in the sieve of what stays.
    marked = rows
    for name, hashes in {_OPEN: open_rows, _KEPT: kept}.items():
        marked = with_sieve(marked, ROW, written(sieve_pages(hashes), "sieve"), name)
    sure = marked.filter(~F.col(_OPEN))
    decided = marked.filter(F.col(_OPEN) & F.col(_KEPT)).join(kept, ROW, "left_semi").dropDuplicates([ROW])
    return sure.select(docs.columns).union(decided.select(docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    back = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    return back.select(
        "doc_id",
        "lang",
        "source",
        F.col("decoded").cast("string").alias("text"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    folder = new_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None

# As in the modules of queries.
QUERIES = {"pipeline": run}
SQL = {name: text for name, text in {"pipeline": ORACLE_SQL}.items() if text}
