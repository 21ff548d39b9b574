"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again
as the next one's input.

1. toxicity: documents that the classifier rejects go.
2. line_dedup: repeated passages of two lines or more are taken out of the texts; no document goes.
3. near_duplicates: of each component of near duplicates the least doc_id stays.
4. mixing: each document as often as the source mix takes it.
5. bpe: token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from tabulon.llm.common import table
from tabulon.session import shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold; the model is trained on the
    stage's own documents and the labels outside the held-out third."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, score_col="__score", keep=[*docs.columns]).where(
        F.col("__score") < toxicity.THRESHOLD).drop("__score")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without repeated passages, n_chars counted anew."""
    done = line_dedup.dedup_lines(docs)
    return done.select(*[F.col("text") if c == "text" else
                         F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                         F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the least doc_id; documents without an id stay."""
    found = jaccard_join.near_duplicates(docs)
    gone = found.where("id != component").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as they are taken."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids and digests of every text of the mix."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                      keep=("doc_id", "source"), outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("bpe", tokenize)]

#: The toxicity model and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, "pipeline", name, unique=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
