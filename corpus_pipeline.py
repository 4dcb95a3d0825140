"""A corpus pipeline: language ID, exact and near dedup, mixing to target weights, BPE tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last keep the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.byte_bpe import encode_texts
from quillmill.llm.exact_dedup import exact_duplicates, keep_documents
from quillmill.llm.language_id import UNKNOWN, identify_languages, language_samples
from quillmill.llm.mixing import mix_sources
from quillmill.llm.near_dedup import near_duplicates
from quillmill.staging import stage

PERCENT = 80
"""Share of shingles from which documents count as near duplicates."""

ORACLE_SQL = None  # language ID, rounding and BPE are not for SQL; tests hold the stages against models


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told: null or empty texts, and those without letters.

    Languages are learned from the documents' own labels; the label `und` names none. All other rows stay
    as they are, also where no row has a label. A label that the parse does not bear out is no reason to drop a
    document: labels are noisy, and clean documents stay.
    """
    samples = [sample for sample in language_samples(docs) if sample[0] != UNKNOWN]
    # Numbered names, so that no column of the documents has a name of the result.
    names = [name if name in ("doc_id", "text") else f"column {i}" for i, name in enumerate(docs.columns)]
    found = identify_languages(docs.toDF(*names), samples or [("any", "")], carry=True)
    return found.where(F.col("predicted language") != UNKNOWN).select(*map(_quoted, names)).toDF(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the largest doc_id stays."""
    return keep_documents(docs, exact_duplicates(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays; rows without doc_id all stay."""
    kept = near_duplicates(docs, PERCENT).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept id")).distinct()
    named = docs.where("doc_id IS NOT NULL")
    return named.join(kept, named["doc_id"] == kept["kept id"], "left_semi").unionByName(docs.where("doc_id IS NULL"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it, rows that share a doc_id or have none as well."""
    row = "row of the mix"
    told = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    copies = mix_sources(told, keep=row).select(F.col(f"`{row}`").alias("mixed row"), F.col("copies").alias("copies of it")).where("`copies of it` > 0")
    met = told.join(copies, told[row] == copies["mixed row"])
    times = F.explode(F.sequence(F.lit(1), F.col("copies of it").cast("int"))).alias("number of the copy")
    return met.select(*map(_quoted, docs.columns), times).drop("number of the copy")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, ids, n_tokens` for every row: the tokens of its whole text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return encode_texts(docs, path, pattern).withColumn("n_tokens", F.size("ids").cast("long"))


def _quoted(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
