"""A training corpus from the documents table: toxic documents go, repeated lines go, one
document of each group of near copies stays, documents with benchmark items go, and the
rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
Its result is written as Parquet in the shared folder and read again by the next stage,
so that a lost executor costs part of one stage. All but the last return the columns of
``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsite.llm import bpe, decontam, jaccard, linededup, toxicity
from loomsite.llm.common import materialize, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the limit; the field learns from ``docs``
    and the labels table.

    Defined cases: as in ``toxicity.score_texts``; without labels nothing is toxic; null
    and empty texts stay; columns of any name are kept."""
    field = toxicity.train(*toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, field)


#: Share of a text's characters, white space aside, of which more must be left for a
#: document to stay after lines of it were removed: the rest is a copy of what stays.
MIN_LEFT = 0.2


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; ``n_chars`` follows the text. A
    document of which ``MIN_LEFT`` or less is left goes: most of it stands in earlier
    documents, and what is left would pass the next stage as a text of its own.

    Defined cases: as in ``linededup.dedup_lines``; null, empty and blank texts lose no
    line and stay; columns of any name are kept."""
    names = ["lines", "removed"]
    while set(names) & set(docs.columns):
        names = [f"_{n}" for n in names]

    def solid(text: Column) -> Column:
        return F.char_length(F.regexp_replace(text, r"\s", ""))

    found = linededup.dedup_lines(docs.withColumn(f"{names[0]}_solid", solid(F.col("text"))), counts=tuple(names))
    cut = F.col(names[1]) > 0
    left = found.where(~cut | (solid(F.col("text")) > F.col(f"{names[0]}_solid") * MIN_LEFT))
    return left.select(*[F.when(cut, F.char_length("text").cast(t)).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose five-word shingles are
    0.8 similar, directly or through others.

    Defined cases: as in ``jaccard.jaccard_components``; texts without words and rows
    with a null id stay; columns of any name are kept."""
    return jaccard.keep_one(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item.

    Defined cases: as in ``decontam.leaks``; null and empty texts and rows with a null id
    stay, as all do under an empty benchmark; columns of any name are kept."""
    return decontam.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """-> ``(doc_id, n_tokens, ids array<int>)``.

    Defined cases: as in ``bpe.encode``; null and empty texts have no tokens."""
    return bpe.encode(docs, bpe.default_tokenizer(), arrays=True)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("bpe_encode", encode),
]

#: The trained filter can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
