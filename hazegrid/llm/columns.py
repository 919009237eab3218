"""Columns computed from a text column, batch by batch, with all other columns kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: Bytes of the source column handled at once, unless one value is longer: Python objects take many times that.
SLICE = 1 << 20


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of `df`, as expressions can name them, that are not among `names` in any case."""
    gone = {n.lower() for n in names}
    return ["`" + c.replace("`", "``") + "`" for c in df.columns if c.lower() not in gone]


def sliced(batch: pa.RecordBatch, source: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about SLICE bytes of its column `source`."""
    column = batch.column(source)
    rows = max(1, int(len(column) * SLICE / max(column.nbytes, 1)))
    for at in range(0, len(column), rows):
        yield batch.slice(at, rows)


def added(df: DataFrame, fields: str, source: str, make: Callable[[pa.Array], list]) -> DataFrame:
    """`df` with the columns of the DDL `fields`, which `make` computes from an Arrow array of column `source`.

    A column of the same name is replaced, as withColumn does; rows, their order in a partition and all
    other columns stay. An empty table gives an empty one with the same columns.
    """
    new = StructType.fromDDL(fields)
    names = set(new.names)
    schema = StructType([f for f in df.schema if f.name not in names] + list(new))
    arrow = to_arrow_schema(schema)
    kept = [f.name for f in schema if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, source)):
            values = make(batch.column(source))
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(v, arrow.field(n).type) if not isinstance(v, pa.Array) else v
                        for n, v in zip(new.names, values, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [c.cast(arrow.field(i).type) if c.type != arrow.field(i).type else c for i, c in enumerate(columns)],
                schema=arrow)

    return df.mapInArrow(run, schema)
