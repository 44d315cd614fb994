"""What the operators share: tables in the shared folder, whole texts, slices of a batch."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKAGE_ZIP = "wardstats-package"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one where that is unset and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder; the executors need one that they share")
        folder = tempfile.mkdtemp(prefix="wardstats-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def cleaned_shuffles(spark: SparkSession):
    """Shuffle files of the jobs inside go as soon as each job has written its table."""
    before = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


# The (session, path) of the tables written in the innermost ``intermediate`` block.
_written: ContextVar[list | None] = ContextVar("written", default=None)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Later jobs read the table, whatever executor is lost, and neither repeat
    the work nor hold its shuffle files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _written.get() is not None:
        _written.get().append((spark, path))
    with cleaned_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediate() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that ``stored`` writes inside go at the end, or when the work inside fails.

    The function that it gives stores a table that stays, until the block around this one ends.
    """
    outer, own, kept = _written.get(), [], []
    token = _written.set(own)

    def keep(df: DataFrame, label: str) -> DataFrame:
        table = stored(df, label)
        kept.append(own.pop())
        return table

    try:
        yield keep
    finally:
        _written.reset(token)
        for spark, path in own:
            _delete(spark, path)
        if outer is not None:
            outer.extend(kept)


def discard(table: DataFrame) -> None:
    """Delete a table that ``stored`` has written and nothing reads any more."""
    files = table.inputFiles()
    if files:
        _delete(table.sparkSession, files[0].rsplit("/", 1)[0])


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def column(name: str) -> Column:
    """The column of exactly that name, which may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_batches(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name: they travel under plain ones."""
    names, new = df.columns, schema.names
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batch.rename_columns(names) for batch in batches):
            yield out.rename_columns(plain.names)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, plain).toDF(*new)


def unused(taken: list[str], name: str) -> str:
    """``name``, with as many underscores behind it as make it new among ``taken``."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``size`` bytes of text each (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n + 1
        if start < batch.num_rows:
            yield batch.slice(start)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, where it isn't installed; once a session."""
    context = spark.sparkContext
    if any(name.startswith(PACKAGE_ZIP) for name in map(os.path.basename, context.listFiles)):
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(), f"{PACKAGE_ZIP}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
