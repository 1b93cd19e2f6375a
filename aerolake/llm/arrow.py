"""Arrow batch helpers for the operators that run Python inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Text bytes that one step of a Python operator holds at a time, unless one text alone is longer.
SLICE_BYTES = 4 << 20
# Most rows of one step.
SLICE_ROWS = 2_000


def slices(batches, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of bounded text size: (slice, its texts with nulls as empty). Only the texts of
    one slice are Python objects at a time."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate([*sizes, 0]):
            if i > start and (i == len(sizes) or held + n > max_bytes or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start), [x or "" for x in column.slice(start, i - start).to_pylist()]
                start, held = i, 0
            held += n


def extended(source: DataFrame, more: str, dropped: int = 1) -> StructType:
    """Schema of ``source`` without its last columns, followed by the DDL ``more``."""
    return StructType(source.schema.fields[:len(source.columns) - dropped] + StructType.fromDDL(more).fields)
