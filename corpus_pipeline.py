"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``; ``run`` writes each stage's rows as Parquet into the shared folder and reads
them back for the next one, so a lost executor costs one stage at most.

1. ``toxicity``: documents predicted toxic go.
2. ``minhash``: one document of each near-duplicate group stays.
3. ``decontamination``: documents contaminated by benchmark passages go.
4. ``secrets``: secret spans are replaced by a mark; no document goes.
5. ``packing``: words of every document are placed in sequences of permitted lengths.

Each stage ends with only the tables that its result reads: the others are removed when it returns.

Defined cases: a null or empty text is not toxic, is its own near-duplicate group with the other empty ones, is not
contaminated, has no secret and gets a packing row without a bin; repeated rows are near duplicates of each
other; a document without an id is kept like any other; extra columns of ``documents`` are left out at the first stage; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seasonkit.llm import decontamination, minhash, packing, secret_scan, toxicity
from seasonkit.llm.common import DOCUMENTS, table
from seasonkit.session import ensure_checkpoint_dir, materialize, owns_tables


@owns_tables
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return toxicity.drop_toxic(docs.select(*DOCUMENTS), table(spark, sf_dir, "labels"))


@owns_tables
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return minhash.drop_near_duplicates(docs.select(*DOCUMENTS))


@owns_tables
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return decontamination.drop_contaminated(docs.select(*DOCUMENTS), table(spark, sf_dir, "benchmark"))


@owns_tables
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs.select(*DOCUMENTS))


@owns_tables
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The classifier, the sampled hashes and the packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
