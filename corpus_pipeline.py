"""From raw documents to token ids: toxicity, exact and near duplicates, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what the stage before has
written, and returns a DataFrame; all but the last return the columns of documents.
A stage only adds or removes what its operator decides; its operator's docstring defines nulls,
empty texts, ties and repeated rows, and extra columns of ``docs`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup, jaccard_join, mixing, piece_codec, toxicity
from corpusmill.sources.sinks import materialize

REJECT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches ``REJECT`` go; the score is learned from the labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, out="__toxicity")
    return scored.filter(F.col("__toxicity") < REJECT).drop("__toxicity")


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8, linked directly or by others) one stays."""
    return jaccard_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them, in training order: some twice, some cut, some not at all."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with begin and end (little-endian 32-bit), and digests of ids and decoded text."""
    import public_tokenizers
    out = piece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(*[c for c in docs.columns if c != "text"], "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact),
    ("near dedup", drop_near),
    ("mix sources", mix_sources),
    ("encode", encode),
]

#: a trained classifier and a tokenizer are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each on what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
