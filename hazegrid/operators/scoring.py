"""All models of all horizons over one table: features are scaled once and the table is read once."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hazegrid.operators.linear import Plane
from hazegrid.operators.trees import Forest

#: Bytes of all forests that may travel with the tasks; larger sets are scored in parts by the caller.
FOREST_LIMIT = 1 << 30


def height(x: Column, plane: Plane) -> Column:
    """Value of a plane over the array of scaled features."""
    products = F.zip_with(x, F.array(*map(F.lit, plane.coefficients)), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(plane.intercept)), lambda s, v: s + v)


def with_forests(df: DataFrame, x: str, forests: Sequence[Forest], name: str) -> DataFrame:
    """`df` with the array `name`: the values of all forests, one after the other, for features in the array column `x`."""
    forests = list(forests)
    size = sum(f.size for f in forests)
    if size > FOREST_LIMIT:
        raise ValueError(f"{size} bytes of trees are too many for one pass; score fewer forests at once")
    schema = StructType(df.schema.fields + StructType.fromDDL(f"`{name}` array<double>").fields)
    arrow, width = to_arrow_schema(schema), sum(f.value.shape[1] for f in forests)
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(x))
            rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
            values = np.concatenate([f.predicted(rows) for f in forests], axis=1) if len(rows) else np.zeros((0, width))
            packed = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*(c.cast(t.type) for c, t in zip(batch.columns, arrow)), packed.cast(arrow.field(name).type)], schema=arrow)

    return df.mapInArrow(run, schema)


register_pickle_by_value(sys.modules[__name__])  # tasks get the functions themselves and needn't import them
