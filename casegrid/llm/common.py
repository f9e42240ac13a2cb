"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Rows of an Arrow batch: whole texts are long, and a task holds a batch on
#: either side of its Python worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of ``BATCH_ROWS`` from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_digest(name: str = "text") -> Column:
    """16 bytes that stand for the text; null and empty text have their own."""
    return F.unhex(F.md5(F.coalesce(F.col(name), F.lit("\x00null"))))


def keyed(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``row`` beside their key ``(id, digest)``.

    The key is the document's number and a digest of its text, so it is the
    same when a lost task runs again, and rows that repeat share it.  Extra
    columns of the input stay inside the struct: no name can clash.
    """
    return docs.select(F.col("doc_id").cast("long").alias("id"), text_digest().alias("digest"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unkeyed(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``most`` bytes, one text at least."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > most:
            yield at, k
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of ``(id, text)`` batches, about ``most`` bytes of text
    at a time, whatever the size of the batches."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
            if texts and size + len(t) > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts
