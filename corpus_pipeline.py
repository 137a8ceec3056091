"""A training-data pipeline over ``documents``.

Each stage is one operator of ``forecourt.llm``; what it returns is written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``; the last adds the token ids and their digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import bpe, decontaminate, lines, simhash, toxicity
from forecourt.llm.common import ship, staged, table, unused
from forecourt.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go.  The model learns from the labels of ``sf_dir``
    and the texts at hand, held-out rows left out."""
    model = toxicity.fit(docs, table(ship(spark), sf_dir, "labels"), learn=~toxicity.held_out())
    name = unused(docs, "score")
    return toxicity.score(docs, model, score_col=name).filter(F.col(name) < 0.5).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occurred earlier go; every document stays, ``n_chars`` follows its text."""
    ship(spark)
    left = lines.dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component stays."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of the bytes that they decode to."""
    import public_tokenizers

    names = vocabulary("byte_bpe_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, names, public_tokenizers.PATTERN), names)
    return both.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn(
        "decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("bpe", tokenize)]

#: SQL has neither the classifier's compressor nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
