"""From raw documents to packed training sequences, in five stages over all that the stage before has kept.

Toxic documents go, one document of each near-duplicate group stays, secrets are replaced by their kind, documents are laid
out in the order of the mix of sources, and what is left is cut into windows. Every stage's result is written to the
shared folder and read again by the next, so a lost executor costs at most one stage's tasks.

No SQL states all stages: the network of the first is trained, and token ids come from a vocabulary file. The tests hold
every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.llm import mixing, near_dedup, packing, secrets, toxicity
from adlattice.session import scratch_path

ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the network, trained on the labelled rows of ``docs``, predicts to be toxic."""
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, network)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the smallest id; of equal rows with that id, one.

    Documents without words are linked with nothing and stay, as do rows without an id. Where rows with different texts
    share an id, they go only if all of them would.
    """
    groups = near_dedup.near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    # The join deals texts by id, which also brings equal rows together.
    return docs.join(groups.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(docs.columns).dropDuplicates()


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind; ``n_chars`` follows the text."""
    redacted = secrets.redact_secrets(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files in name order, rows in file order."""
    return mixing.in_mix_order(docs, mixing.mix_sources(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset; sequences follow the order of the files of ``docs``."""
    placed = mixing.with_file_order(docs, "place")
    return packing.pack(packing.token_pieces(placed, packing.byte_bpe(), order="place"), order="place").drop("place")


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
    ("mixing", mix_sources), ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
