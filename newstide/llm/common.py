"""What the operators share: tables, cut lineage, Arrow batches, text conventions."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.session import work_folder

#: rows, and bytes, handed to Python at once; a batch of long documents must fit a worker
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name the frame lacks, for a helper column that stands beside its own."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame stored in a fresh folder all executors share, and read again.

    Later steps depend on the files alone: a lost executor costs its own tasks only.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def _bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def by_batch(
    frame: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]]
) -> DataFrame:
    """``mapInArrow`` for a function that gives a dict of columns for each batch it reads.

    Batches are bounded in rows and bytes, so that many long texts never stand in memory
    together, in Python or in the JVM.
    """
    _bound_batches(frame.sparkSession)
    fields = frame.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)
        pieces = (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))
        for columns in work(pieces):
            arrays = [pa.array(columns[f.name], f.type, from_pandas=False) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return frame.mapInArrow(run, fields)


def filtered(frame: DataFrame, judge: Callable[[list[str]], Iterable[bool]]) -> DataFrame:
    """The rows whose ``text`` (null: empty) the judge accepts, with all their columns."""
    _bound_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(ok) for ok in judge(texts(batch))], pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % folds).cast("int")


def crc_hash(word: str) -> int:
    """A hash that is the same in every process (Python's own is salted)."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))
