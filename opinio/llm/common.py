"""Helpers shared by the training-data operators.

Scratch tables go to the shared folder named by ``spark.checkpoint.dir`` as Parquet, so a
lost executor never loses them and later reads take only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows that a task turns into Python objects at a time (Arrow batches are cut to this size).
SLICE_ROWS = 1024

#: Words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z. On UTF-8 bytes
#: that is a translation (every other byte becomes a space) and a split.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(data: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; none for null."""
    return data.translate(_WORD_BYTES).split() if data else []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="opinio-llm-", dir="/tmp"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe to read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/opinio-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(name: str) -> Column:
    """A text column as UTF-8 bytes (null stays null)."""
    return F.col(name).cast("string").cast("binary")


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def small(df: DataFrame, text_col: str, rows: int = 200_000, size: int = 16 << 20) -> DataFrame:
    """``df`` hinted for broadcast if it has at most so many rows and bytes of ``text_col``, else as it is."""
    n, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= size else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function from a small batch to the columns of its result."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict(fn(part), schema=arrow)

    return df.mapInArrow(run, kind)


def filter_batches(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` (all columns) for which ``keep`` says true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kept = part.filter(pa.array(keep(part), pa.bool_()))
            if kept.num_rows:
                yield kept

    return df.mapInArrow(run, df.schema)
