"""Rows that enclose others by their level, as headings do: one pass over each book in order."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType


def nested(rows: DataFrame, book: str, order: list[str], level: str) -> DataFrame:
    """me, parent, closer: each row, the nearest row before it of a lower level, and the next one of its own or a lower level.

    All three are structs of the columns of rows; level is not NULL. Rows are dealt by book and sorted; a task holds only the rows
    that are still open, one a level at most, so a book of any length takes the same memory and one step a row.
    """
    columns = rows.columns
    one = StructType(rows.schema.fields)
    kind = to_arrow_type(one)
    out = StructType([StructField(n, one) for n in ("me", "parent", "closer")])
    at_book, at_level = columns.index(book), columns.index(level)

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x in zip(*found, strict=True)], names=out.names)

    def fold(batches):
        open_: list[tuple] = []  # (level, row, parent), levels rising
        here = None
        for b in batches:
            found = []
            for values in zip(*[b.column(i).to_pylist() for i in range(len(columns))], strict=True):
                if open_ and values[at_book] != here:
                    found += [(row, parent, None) for _, row, parent in open_]
                    open_ = []
                here, me = values[at_book], dict(zip(columns, values, strict=True))
                while open_ and open_[-1][0] >= values[at_level]:
                    _, row, parent = open_.pop()
                    found.append((row, parent, me))
                open_.append((values[at_level], me, open_[-1][1] if open_ else None))
            if found:
                yield batch(found)
        if open_:
            yield batch([(row, parent, None) for _, row, parent in open_])

    return rows.repartition(book).sortWithinPartitions(book, *order).select(*[F.col(c) for c in columns]).mapInArrow(fold, out)
