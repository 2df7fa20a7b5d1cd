"""The corpus pipeline: toxic documents out, near-copies out, benchmark passages out, personal data
replaced, the rest packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataline.llm.decontaminate import without_contaminated
from strataline.llm.jaccard import one_of_each
from strataline.llm.packing import pack_documents
from strataline.llm.pii import redact
from strataline.llm.queries import table
from strataline.llm.storage import stored
from strataline.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject.

    Null and wordless texts stay or go by the score of no terms; repeated rows are treated alike;
    without usable labels all stay; an empty table stays empty.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies.

    Null and wordless texts are a class of their own for each id and text, of rows with equal id
    and text one stays; an empty table stays empty.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    Null, empty and wordless texts stay, repeated rows stay or go together, and with an empty
    benchmark all stay; an empty table stays empty.
    """
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind.

    Null and empty texts stay as they are, repeated rows are replaced alike; an empty table stays
    empty.
    """
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, sequences and offsets.

    A null or empty text has its end id only; repeated rows are packed once each; an empty table
    gives no pieces.
    """
    return pack_documents(docs, "word_bpe_49k.json", end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The stages fit models and search by sketches, which SQL can't express; tests compare each
#: stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
