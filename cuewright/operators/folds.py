"""Folds over ordered rows: what a row gets follows from the row and a few values kept from the row before."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Of a row's values, the values that are added to it; it may keep some for the next row of the key.
Step = Callable[..., tuple]


def folded(rows: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str], start: Callable[[], Step], adds: str) -> DataFrame:
    """``rows`` with the columns ``adds``; ``start`` makes a step for each key, which is called with ``columns`` in order.

    Rows stream through a task in sorted batches: a key's rows never meet in
    memory, whatever their number, and other columns pass as they are.  The window
    has a key's rows together and sorted; rows that are so already aren't shuffled.
    """
    added = T.StructType.fromDDL(adds)
    schema = T.StructType([*rows.schema, *added])
    types = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, now = None, None
        for batch in batches:
            out = []
            for k, values in zip(zip(*(batch.column(c).to_pylist() for c in key), strict=True), zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
                if step is None or k != now:
                    step, now = start(), k
                out.append(step(*values))
            fresh = [pa.array(v, type=t) for v, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], type=t) for t in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *fresh], names=schema.names)

    together = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return together.sortWithinPartitions(*key, *order).mapInArrow(run, schema)
