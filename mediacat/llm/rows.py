"""Measures of texts appended to the rows that hold them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import SLICE_BYTES, text_slices

Measure = Callable[[pa.Array], list[pa.Array]]


def appended(docs: DataFrame, text: str, ddl: str, begin: Callable[[], Measure], keep: list[str] | None = None,
             limit: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with the columns of ``ddl``, computed from ``text`` a slice of rows at a time.

    ``begin`` runs once in a task and gives the function from texts to new columns.
    ``keep`` names the columns that stay (all of them by default); a new column takes the
    place of one with the same name.
    """
    new = T.StructType.fromDDL(ddl)
    taken = {f.name.lower() for f in new}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    kept = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text"))
    if text in names:  # sent once
        kept = kept.select(*[F.col(f"`{c}`") for c in names])
        at = names.index(text)
    else:
        at = len(names)
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in names]).schema.fields, *new.fields])
    labels, n = [f.name for f in schema.fields], len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = begin()
        for batch in batches:
            for rows in text_slices(batch, batch.schema.names[at], limit):
                columns = [rows.column(i) for i in range(n)] + measure(rows.column(at))
                yield pa.RecordBatch.from_arrays(columns, labels)
            pa.default_memory_pool().release_unused()

    return kept.mapInArrow(run, schema)
