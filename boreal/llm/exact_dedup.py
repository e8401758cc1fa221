"""Exact duplicates by deterministic block naming, with DataFrame functions only.

Method: a normalised text is cut into fixed-size byte blocks. Distinct blocks are sorted and numbered:
equal blocks get one integer name, different blocks different names. Then adjacent names are paired,
distinct pairs are sorted and numbered in turn, and so on until every document is one name. Two
documents are equal exactly when they have the same number of blocks and the same last name.

No hash decides equality. Block contents travel once, de-duplicated before the shuffle, to be compared:
a hash value under which all contents are equal stands for its content from then on; contents that share
a hash value are told apart by their rank among them. Everything later moves integers only.

Scale: names are numbered within buckets of a hash, so no step is one sorted list; a group of copies
that holds a third of all rows is one row per task in every count of distinct keys, and joins on
names are plain equi-joins whose hot keys AQE splits. The number of rounds is the logarithm of the
longest text's blocks. Tables between rounds are written to the shared folder.

Edge cases: null counts as empty; empty texts are equal; rows with the same document id are separate
documents, of which the first read stays if their id is the largest; a null id is smaller than any
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.llm.storage import ascii_lower, shuffle_partitions, written


def numbered(keys: DataFrame, name: str) -> DataFrame:
    """Distinct rows of ``keys`` with a unique integer: sorted and counted within hash buckets."""
    buckets = shuffle_partitions(keys.sparkSession)
    columns = keys.columns
    order = Window.partitionBy("__bucket").orderBy(*columns)
    return (keys.distinct()
            .withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
            .withColumn(name, F.shiftleft(F.col("__bucket").cast("long"), 40) + F.row_number().over(order))
            .drop("__bucket"))


def name_blocks(docs: DataFrame, block_bytes: int, block_hash: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """``docs`` has doc_id and text (normalised, as bytes). Returns documents (row, doc_id, sha256, hashes,
    n_blocks) and their blocks (row, n, pos, name), n being the number of the document's blocks."""
    def cut(text: Column) -> Column:
        n = F.ceil(F.octet_length(text) / block_bytes).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(
            text, i * block_bytes + 1, F.lit(block_bytes)))).otherwise(F.array().cast("array<binary>"))

    blocks = docs.select(F.explode(cut(F.col("text"))).alias("block"))
    contents = blocks.select(block_hash(F.col("block")).alias("hash"), "block").distinct()
    hashes = written(contents.groupBy("hash").agg(F.count(F.lit(1)).alias("contents")), "block-hashes")

    shared = hashes.filter("contents > 1").select("hash")
    collision = not shared.isEmpty()
    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if collision:
        docs = written(docs, "documents-with-rows")
    rows = written(docs.select("row", "doc_id", F.sha2("text", 256).alias("sha256"), F.transform(
        cut(F.col("text")), lambda block: block_hash(block)).alias("hashes")).withColumn("n_blocks", F.size("hashes")), "documents")
    placed = rows.select("row", F.col("n_blocks").alias("n"), F.posexplode("hashes").alias("pos", "hash"))
    if collision:  # different blocks under one hash value: rank their contents
        found = (docs.select("row", F.posexplode(cut(F.col("text"))).alias("pos", "block"))
                 .withColumn("hash", block_hash(F.col("block"))).join(shared, "hash", "left_semi"))
        ranks = found.select("hash", "block").distinct().withColumn(
            "rank", F.row_number().over(Window.partitionBy("hash").orderBy("block")))
        ranked = found.join(ranks, ["hash", "block"]).select("row", "pos", "rank")
        placed = placed.join(ranked, ["row", "pos"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    else:
        placed = placed.withColumn("rank", F.lit(0))
    names = numbered(placed.select("hash", "rank"), "name")
    return rows, placed.join(names, ["hash", "rank"]).select("row", "n", "pos", "name")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     normalise: Callable[[Column], Column] = ascii_lower, block_bytes: int = 4096,
                     block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id of the equal texts), group_size, kept, text_sha256."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                         normalise(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("binary").alias("text"))
    rows, named = name_blocks(source, block_bytes, block_hash)
    longest = rows.agg(F.max("n_blocks")).first()[0] or 0
    done = []
    while True:
        named = written(named, "names")
        done.append(named.filter("n = 1").select("row", "name"))
        if longest <= 1:
            break
        pairs = named.filter("n > 1").groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.expr("(max(n) + 1) div 2").cast("int").alias("n"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"))
        names = numbered(pairs.select("left", "right"), "name")
        named = pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name")
        longest = (longest + 1) // 2
    whole = rows.join(reduce(DataFrame.unionByName, done), "row", "left").select(
        "row", "doc_id", "sha256", "n_blocks", F.coalesce("name", F.lit(-1)).alias("name"))
    groups = whole.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("first"))).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return whole.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("keep.first")).alias("kept"), F.col("sha256").alias("text_sha256"))
