"""Small in-memory control tables (bindings, topic lists, catalogs).

Built as SQL ``VALUES`` so Spark plans them as a ``LocalRelation``: the rows
live in the plan, no RDD or Python worker is involved, and the optimizer
knows their exact size (which lets the broadcast size check skip its count).
Meant for control-plane rows a user types or a driver-side registry holds,
never for data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _literal(value, dtype: T.DataType) -> str:
    sql_type = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {sql_type})"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if value else "FALSE"
    if isinstance(dtype, T.BinaryType):
        return f"X'{bytes(value).hex()}'"
    if isinstance(dtype, T.StringType):
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST({int(value)} AS {sql_type})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST('{float(value)!r}' AS {sql_type})"
    raise TypeError(f"unsupported type for a local table: {sql_type}")


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small DataFrame from Python rows, planned as a ``LocalRelation``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    rows = list(rows)
    names = ", ".join(f"`{f.name}`" for f in fields)
    typed = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    values = []
    for r in rows:
        if len(r) != len(fields):
            raise ValueError(f"row {r!r} does not match {len(fields)} columns")
        values.append("(" + ", ".join(_literal(v, f.dataType) for v, f in zip(r, fields)) + ")")
    return spark.sql(f"SELECT {typed} FROM VALUES {', '.join(values)} AS t({names})")
