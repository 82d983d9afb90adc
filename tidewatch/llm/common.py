"""Input columns, row identity and worker settings shared by the operators of this package.

Every operator reads two columns, an id and a text, and selects them under fixed names first, so
that further columns of the input, whatever their names, cannot clash with its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ship

#: Rows of one Arrow batch. Texts may be megabytes long, so a batch holds few of them.
BATCH_ROWS = 1000

#: Rows of this many text bytes are handled together inside a task.
BLOCK_BYTES = 8 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package, and lower the Arrow batch size, which bounds a worker's memory on long texts."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string); a null text becomes an empty one."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def unused(name: str, columns: list[str]) -> str:
    """`name`, with underscores behind it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a document: rows that repeat both id and text are one document."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.col(text))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Join or cut Arrow batches to tables of about `size` bytes of `column`; a longer row stands alone."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lengths):
            if held_bytes + n > size and (held or i > start):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, held_bytes, start = [], 0, i
                # What the last block took goes back to the machine, which other workers share.
                pa.default_memory_pool().release_unused()
            held_bytes += int(n)
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def per_block(df: DataFrame, column: str, schema: str, fn: Callable[[pa.Table], pa.Table | None]) -> DataFrame:
    """`fn` on blocks of rows inside each task; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, column):
            out = fn(table)
            if out is not None:
                yield from out.combine_chunks().to_batches()

    return df.mapInArrow(run, schema)
