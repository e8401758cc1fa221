"""A corpus pipeline over ``documents``: five stages, each calling one operator of ``boreal.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``, extra ones unchanged whatever their names.

Edge cases: null texts and texts without a letter go at the first stage; null languages are not learned from;
rows that share an id, or have none, stay or go together; of equally good copies the stated id
stays; texts of any length are whole in every stage; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.llm import exact_dedup, jaccard_join, language_id, packing, substring_dedup
from boreal.llm.queries import documents, tokenizer_file
from boreal.llm.storage import written


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__kept"]), "left_semi")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier is sure of; it learns from a bounded sample of the labelled ones."""
    model = language_id.train(docs)
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return language_id.predict(rows, model).filter("accepted").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the document with the largest id."""
    return _kept(docs, exact_dedup.duplicate_groups(docs).filter("kept"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of common five-word shingles, the one with the smallest id."""
    groups = jaccard_join.similar_documents(docs, size=5, percent=80)
    return _kept(docs, groups.filter("component_id <=> doc_id"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that stand in an earlier document are cut out; a document that has no
    word left goes."""
    cut = substring_dedup.without_passages(docs, substring_dedup.passages(docs))
    cut = cut.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 4096 tokens."""
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
