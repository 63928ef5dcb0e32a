"""Corpus pipeline: toxic documents go, near-duplicates go, secrets are masked, sources are mixed, text is encoded.

Each stage takes (spark, docs, sf_dir), works on all rows of docs, and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` stores each stage's rows as Parquet in the shared
folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.llm import mixing, secrets, sentencepiece_codec, shingle_sets, toxicity
from skyfact.llm.queries import sized, toxicity_model
from skyfact.llm.shared import picked, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model finds toxic go; those with null or empty text stay, as far as the bias says."""
    docs = _input(docs)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that pairs with 0.8 of their five-word shingles in common make stays.

    SimHash fingerprints of the shingles, searched by the pigeonring, give the first pairs, which an exact check has
    to confirm; pairs with more bits between them come from the rarest shingles, and are checked as well.
    It is the one with the least id, null last; of several with that id, the one whose text has the least
    digest; and of equal texts, the least row.  Ids needn't be unique or known: a row is told by its group.
    Documents without words are a group as any other.
    """
    docs = _input(docs).withColumn("digest", F.xxhash64("text"))
    rows = stored(shingle_sets.groups(docs.select(F.col("doc_id").alias("id"), "digest", "text")), "pipeline-groups")
    keys = rows.groupBy("root", "id", "digest").agg(F.count("*").alias("n"))
    least = keys.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", "n")).alias("kept"))
    return picked(docs, least.select(F.col("kept.id").alias("doc_id"), "kept.digest", F.col("kept.n").alias("_n")), ["doc_id", "digest"]).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of a secret scan is masked; all documents stay, and those without spans as they are."""
    docs = _input(docs)
    scanned = secrets.scan(docs.withColumn("id", F.col("doc_id")), keep=COLUMNS)
    masked = scanned.withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, with a row for each pass in which it takes words of a document; cut documents have the words taken."""
    docs = _input(docs)
    return mixing.excerpts(docs, *mixing.mix(sized(docs)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as SentencePiece ids, and the digest of what they decode to."""
    docs = _input(docs)
    out = sentencepiece_codec.round_trip(docs.select(F.col("doc_id").alias("id"), "text"))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
# The model, the fingerprints and the pieces are beyond SQL; a brute-force version is tested instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
