"""Stored precision: values are rounded to the table's types when written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homegrid.schemas import table_schema


def _stored(field: T.StructField, strict: bool) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, T.VarcharType):
        fits = F.length(col) <= field.dataType.length
        too_long = F.raise_error(
            F.concat(F.lit(f"{field.name} is over {field.dataType.length} long: "), col)
        ).cast("string")
        stored = F.when(fits, col)
        return F.when(col.isNull() | fits, col).otherwise(too_long) if strict else stored
    return col.cast(field.dataType) if strict else col.try_cast(field.dataType)


def _lost(df: DataFrame, table: str) -> dict[str, Column]:
    """Per column whether a value is there that does not fit the table."""
    return {
        f.name: F.col(f.name).isNotNull() & _stored(f, False).isNull()
        for f in table_schema(table).fields
        if f.name in df.columns
    }


def conform(
    df: DataFrame, table: str, on_overflow: str = "error", observed: Observation | str | None = None
) -> DataFrame:
    """The columns of ``table``, in its order and types; decimals round half up.

    A value that does not fit raises (``"error"``) or becomes NULL (``"null"``). A column
    which ``df`` lacks is NULL. ``observed`` counts rows and lost values of each column in the
    same pass.
    """
    if observed is not None:
        counts = [F.count_if(lost).alias(f"lost: {name}") for name, lost in _lost(df, table).items()]
        df = df.observe(observed, F.count(F.lit(1)).alias("rows"), *counts)
    fields = table_schema(table).fields
    for field in fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast("string"))
    strict = on_overflow == "error"
    return df.select(*[_stored(f, strict).alias(f.name) for f in fields])


def conform_rejects(df: DataFrame, table: str) -> DataFrame:
    """Rows with a value that does not fit the table."""
    return df.filter(reduce(lambda a, b: a | b, _lost(df, table).values(), F.lit(False)))
