"""Where the operators keep intermediate tables and their own files: a folder all machines share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import session

#: Rows in one Arrow batch; long texts would make the default of 10,000 rows too large.
BATCH_ROWS = 512
#: And bytes in one.
BATCH_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one beside the warehouse, unless
    that is a folder of one machine on a cluster."""
    return as_uri(session.shared_folder(spark))


def as_uri(path: str) -> str:
    """A path that both Spark and pyarrow read: `file:/x` and `/x` become `file:///x`."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    if "://" not in path:
        return "file://" + os.path.abspath(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """The address of a folder of this run; nobody else uses it."""
    return f"{shared_folder(spark).rstrip('/')}/strataline-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a folder of its own and read it back: it is computed once, its
    lineage ends there, and it outlives the executors that made it."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def sampled(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About `rows` rows, at most twice as many: those whose hash of `columns` is small enough.

    The bound on the hash follows from the number of rows, so nothing is sorted or gathered, and
    the same rows are drawn each time.
    """
    share = min(1.0, rows / max(1, df.count()))
    if share == 1.0:
        return df
    bound = int(-(2**63) + share * 2**64)
    return df.where(F.xxhash64(*columns) < F.lit(bound)).limit(2 * rows)


def row_key() -> Column:
    """128 bits that only rows with equal id and text share; null is no text, nor an empty one."""
    part = lambda c, kind: F.coalesce(F.concat(F.lit("="), F.col(c).cast(kind).cast("string")), F.lit("0"))
    return F.unhex(F.md5(F.concat(part("doc_id", "long"), F.lit("|"), part("text", "string"))))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _number(setting: str) -> int:
    """A count or a size as Spark writes them: 512, 64m, 67108864b."""
    digits = setting.lower().rstrip("bkmgt")
    unit = setting.lower().removeprefix(digits).rstrip("b")
    return int(digits) << (10 * ("kmgt".index(unit) + 1) if unit else 0)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts, in rows and in bytes. Lowers session
    settings, never raises them. A single text may be longer than a batch."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = _number(spark.conf.get(f"spark.sql.execution.arrow.{key}"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def opened(uri: str):
    """The pyarrow file system of an address, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(as_uri(uri))


class AttemptFile:
    """A file that appears under its name only when complete.

    Each attempt of a task writes under a name of its own and renames at the end, so a lost
    or repeated task leaves either nothing or the same whole file.
    """

    def __init__(self, folder: str, name: str) -> None:
        from pyspark import TaskContext

        context = TaskContext.get()
        self.fs, base = opened(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.uri = f"{folder}/{name}"
        self.attempt = f"{base}/_attempt-{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.attempt)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> str:
        self.stream.close()
        self.fs.move(self.attempt, self.path)
        return self.uri
