"""Schemas and record batches of the operators that work on Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_KINDS = {
    "short": T.ShortType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(), "bool": T.BooleanType(),
    "binary": T.BinaryType(), "string": T.StringType(),
}


def record(**kinds: str) -> T.StructType:
    """A schema: kind names as above, or [name] for arrays of them."""
    one = lambda kind: T.ArrayType(_KINDS[kind[1:-1]]) if kind[0] == "[" else _KINDS[kind]
    return T.StructType([T.StructField(name, one(kind)) for name, kind in kinds.items()])


def batch_of(kind: T.StructType, columns: list) -> pa.RecordBatch:
    schema = to_arrow_schema(kind)
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
