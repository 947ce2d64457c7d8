"""JSON text to typed columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _as_text(dtype: T.DataType) -> T.DataType:
    """The same shape with every leaf read as text."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_as_text(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), T.StringType(), True)
    return T.StringType()


def evaluate_once(df: DataFrame, struct: Column, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus the fields of ``struct``, which is computed a single time per row.

    Filters over a projection are moved below it and repeat its expressions, which
    for a JSON parse costs more than all the rest.  They are not moved below a
    generator, so the struct is passed through one.
    """
    return df.select(*keep, F.inline(F.array(struct)))


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column into typed columns plus ``_corrupt_record``.

    Numbers may be written plain or quoted, as change records often quote them:
    leaves are read as text and then cast, and a leaf that does not fit its type
    becomes null without losing the row.  Text that is no JSON object at all is
    kept in ``_corrupt_record``.
    """
    text = T.StructType(_as_text(schema).fields + [T.StructField(CORRUPT, T.StringType(), True)])
    typed = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json(F.col(value), text, {"columnNameOfCorruptRecord": CORRUPT})
    return evaluate_once(df, parsed.try_cast(typed), keep)


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows)."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad)


def to_json_text(*columns: Column | str) -> Column:
    """One JSON object from the given columns; null fields are left out."""
    return F.to_json(F.struct(*columns))


def to_json_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON object in a column ``value``."""
    return df.select(to_json_text("*").alias("value"))
