"""The operators over whole tables, with production parameters, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.llm import byte_bpe, centroids, embedding_dedup, exact_topk, licenses, merkle, mixing, secrets, sentencepiece_codec, simhash, substring_dedup, toxicity, warc
from skyfact.llm.shared import table


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), "text")


def substring_dedup_docs(spark: SparkSession, d: str) -> DataFrame:
    out = substring_dedup.repeated_spans(_texts(table(spark, d, "documents")))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text, source -> what the mix needs; the digest tells equal ids apart."""
    return docs.select(F.col("doc_id").alias("id"), "source", mixing.n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))


def mixture(spark: SparkSession, d: str) -> DataFrame:
    placed, mixed = mixing.mix(sized(table(spark, d, "documents")))
    return mixing.taken(placed, mixed).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def topk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), exact_topk.scaled(F.col("embedding")).alias("vector"))
    out = exact_topk.top_k(rows, rows.filter(F.col("id") % 20 == 0))
    return out.select(F.col("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def secret_spans(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("spans")
    base = F.filter(s, lambda x: x["kind"].isin(list(secrets.STRONG)))
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    return secrets.scan(_texts(table(spark, d, "documents"))).select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"), secrets.joined(s).alias("spans"),
    )


def pieces(spark: SparkSession, d: str) -> DataFrame:
    out = sentencepiece_codec.round_trip(_texts(table(spark, d, "documents")))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def near_documents(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(_texts(table(spark, d, "documents"))).withColumnRenamed("id", "doc_id")


def license_labels(spark: SparkSession, d: str) -> DataFrame:
    out = licenses.scan(_texts(table(spark, d, "documents")))
    return out.withColumnRenamed("id", "doc_id").withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")} | {"score": F.round("score", 9)})


def archive(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("uri"), "html")
    page = lambda c: F.expr(f"try_cast(substring({c}, 6) AS bigint)")
    response = F.col("record_type") == "response"
    # the last chunk of a response has measured its payload; a revisit states that of its response
    return warc.archived(pages).filter("last").select(
        page("record_id").alias("page_id"), F.when(response, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
    )


def _held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    ours = lambda df, *cols: df.filter(~_held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), *cols)
    return toxicity.train(ours(docs, "text"), ours(labels, "toxic"))


def toxic(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = toxicity_model(docs, table(spark, d, "labels"))
    return toxicity.score(_texts(docs), model).select(F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "score", "predicted")


def near_embeddings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return embedding_dedup.near_vectors(rows).withColumnRenamed("id", "vec_id")


def byte_pieces(spark: SparkSession, d: str) -> DataFrame:
    out = byte_bpe.round_trip(_texts(table(spark, d, "documents")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def centroid_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return centroids.clusters(rows).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _small_letters(text):
    """A-Z become a-z.  ``lower`` is the faster way, where all characters are of ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    columns = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(touched, merkle.leaf(columns(_small_letters(F.col("text")))))
    leaves = docs.select(F.col("doc_id").alias("id"), "source", merkle.leaf(columns(F.col("text"))).alias("leaf"), tampered.alias("tampered"))
    out = merkle.manifest(leaves).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    proof = F.sha2(merkle.proof_text(F.col("path")).cast("binary"), 256)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_substring_dedup": substring_dedup_docs,
    "op2_source_mixing": mixture,
    "op3_exact_topk": topk,
    "op4_secret_scan": secret_spans,
    "op5_sentencepiece": pieces,
    "op6_simhash_dedup": near_documents,
    "op7_license_scan": license_labels,
    "op8_warc": archive,
    "op9_toxicity": toxic,
    "op10_embedding_dedup": near_embeddings,
    "op11_byte_bpe": byte_pieces,
    "op12_centroids": centroid_clusters,
    "op13_merkle_manifest": manifest,
}
