"""Arrow batches cut by size of text, so that a worker's memory does not follow the length of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], columns: str | list[str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches whose text in `columns` (one, or several together) has about `limit` bytes; a longer row stands alone, and is whole."""
    names = [columns] if isinstance(columns, str) else list(columns)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in names).tolist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def one_per_id(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, columns): one row of each id, as rows of one id are one record; each row without id is a record of its own."""
    kept = df.withColumn("_apart", apart(id_col)).groupBy(id_col, "_apart").agg(*(F.first(c).alias(c) for c in columns))
    return kept.select(id_col, *columns)


def apart(id_col: str) -> Column:
    """A number of its own for each row without id, and null for others: grouped by id and this, rows without id stay apart."""
    return F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
