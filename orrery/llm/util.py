"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.session import materialize
from orrery.sources.tables import table_path

#: ASCII white space: 0x20 and 0x09 to 0x0D, the set bytes.split() uses.
SPACE = " \t\n\x0b\x0c\r"


#: Texts of an Arrow batch: at Spark's 10,000 a batch of long ones, with what a
#: worker makes of it, takes hundreds of MB.
BATCH = 1_000


def short_batches(spark: SparkSession) -> None:
    """Sets the session to Arrow batches of at most ``BATCH`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH:
        spark.conf.set(key, str(BATCH))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(table_path(sf_dir, "documents"))


def narrow(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    """``doc_id`` (long) and ``text`` under fixed names, nothing else but
    ``more``: other columns of the caller, whatever they are called, can't clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       *[c.alias(k) for k, c in more.items()])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once under the shared checkpoint folder and read back: several
    consumers, or a retry after a lost executor, read files."""
    return materialize(df, f"llm-{name}")


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """With doc_id, names a row by content: rows that agree in both get the
    same result, so they need not be told apart."""
    return F.xxhash64(F.col(text), F.col(doc_id))


def next_pow2(n: int) -> int:
    return 1 << max(0, int(n - 1).bit_length())


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def portions(batches: Iterator[pa.Array], rows: int = 500) -> Iterator[pa.Array]:
    """The arrays in short slices, so that what a worker makes of a batch of long
    texts at a time stays small."""
    for batch in batches:
        for i in range(0, max(len(batch), 1), rows):
            yield batch.slice(i, rows)


def letters(text: str) -> int:
    """How many characters are letters (Unicode L); numerals such as ² ½ ① are none."""
    return sum(map(str.isalpha, text))


def planes(*columns: np.ndarray) -> bytes:
    """64-bit columns of one length, byte by byte, compressed: small numbers take little room."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.astype("<i8").view("u1").reshape(-1, 8).T.tobytes() for c in columns))


def from_planes(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view("<i8").ravel() for c in raw]
