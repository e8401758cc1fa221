"""The registered queries of this package, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.llm.oracle import OP5_SQL, OP11_SQL, OP12_SQL, OP13_SQL


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; for the documents whose id is divisible by
    100, also the number of documents within 32 bits of their fingerprint (themselves included)."""
    from boreal.llm.simhash import edited_fingerprints, within_radius
    from boreal.llm.storage import written

    prints = written(edited_fingerprints(documents(spark, sf_dir)), "fingerprints")
    asked = F.col("doc_id") % 100 == 0
    found = within_radius(prints.filter(asked), prints, radius=32).withColumnRenamed("documents", "within_32_bits")
    near = prints.filter(asked).select("doc_id", "fingerprint").join(found, "fingerprint").select("doc_id", "within_32_bits")
    return prints.join(near, "doc_id", "left")


def op2_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    from boreal.llm.sentencepieces import encode_decode

    coded = encode_decode(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more, equal or alike, of a document that stand in an earlier one."""
    from boreal.llm.substring_dedup import passages

    return passages(documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by at least 85 % of common 4-word shingles."""
    from boreal.llm.jaccard_join import similar_documents

    return similar_documents(documents(spark, sf_dir), size=4, percent=85)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without runs of two or more lines that stand earlier in the corpus."""
    from boreal.llm.line_dedup import without_repeated_lines

    cleaned = without_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("n_chars"),
                          F.sha2("text", 256).alias("text_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the documents that are not held out."""
    from boreal.llm import language_id

    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(language_id.fold(F.col("doc_id"), 3) == 1, F.lit(True))
    model = language_id.train(docs.filter(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from boreal.llm.html_text import extract

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a model of the documents that are not held out."""
    from boreal.llm import kneser_ney

    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    model = kneser_ney.train(docs.filter(~held_out), order=2)
    return kneser_ney.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    from boreal.llm.exact_dedup import duplicate_groups

    return duplicate_groups(documents(spark, sf_dir))


OP9_SQL = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
equal AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT n.doc_id, e.keep_id, e.group_size, n.doc_id = e.keep_id AS kept, sha256(n.t) AS text_sha256
FROM normal n JOIN equal e ON n.t = e.t
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 4096 tokens."""
    from boreal.llm.packing import pack

    packed = pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_reached AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(r.y, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least_reached r ON s.doc_id = r.x
"""

def op11_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: certain ones, and weak ones that stand with their complement."""
    from boreal.llm import secret_links as links

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    found = links.credentials(documents(spark, sf_dir))
    return found.select(
        "doc_id", count(links.ASSIGN).alias("n_assign"), count(links.ACCESS).alias("n_access"), count(links.HEX).alias("n_hex"),
        F.sha2(links.as_text(F.col("base")), 256).alias("base_sha256"),
        links.as_text(F.sort_array(F.concat("base", "linked"))).alias("spans"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each beginning with up to three turns of the first of its twenty."""
    from boreal.llm.conversation_trie import ordered_turns, prefix_trie, with_shared_heads

    turns = ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    head = F.crc32(F.col("conv_id").cast("string")) % 4
    return prefix_trie(with_shared_heads(turns, 20, head, 3))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds of sixteen centroids."""
    from boreal.llm.centroids import clusters

    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_sentencepieces, op3_substring_dedup, op4_jaccard_join, op5_line_dedup, op6_language_id,
    op7_html_text, op8_kneser_ney, op9_exact_dedup, op10_packing,
    op11_secret_links, op12_conversation_trie, op13_centroids)}

#: Fingerprints, tokenizers, trained models, page parsing and alignment are beyond SQL.
#: Those queries are tested against brute force, the libraries or held-out rows.
ORACLE_SQL = {"op4_jaccard_join": OP4_SQL, "op5_line_dedup": OP5_SQL, "op9_exact_dedup": OP9_SQL, "op11_secret_links": OP11_SQL,
              "op12_conversation_trie": OP12_SQL, "op13_centroids": OP13_SQL}
