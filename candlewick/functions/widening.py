"""Type widening for schema evolution (S09): a small lattice of lossless casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StructField, StructType,
    TimestampNTZType,
)

# Each type and those it widens to without loss, nearest first. Parquet files of
# the narrower type are read as the wider one, so old files need no rewrite.
WIDER: dict[type[DataType], tuple[type[DataType], ...]] = {
    ByteType: (ShortType, IntegerType, LongType, DoubleType),
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
    DateType: (TimestampNTZType,),
}


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The nearest type that holds both without loss (None: there is none)."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if type(a) is type(b):
        return None   # the same kind with other parameters
    holds_b = (type(b), *WIDER.get(type(b), ()))
    return next((t() for t in (type(a), *WIDER.get(type(a), ())) if t in holds_b), None)


def widen(target: StructType, source: StructType) -> StructType:
    """The target's columns, each as wide as either side needs, then the columns
    that only the source has. Raises for columns without a common type, by name."""
    theirs = {f.name: f for f in source}
    fields, lost = [], []
    for f in target:
        t = common_type(f.dataType, theirs[f.name].dataType) if f.name in theirs else f.dataType
        if t is None:
            lost.append(f"{f.name}: {f.dataType.simpleString()} and {theirs[f.name].dataType.simpleString()}")
        else:
            fields.append(StructField(f.name, t, True))
    if lost:
        raise TypeError("columns without a common type: " + "; ".join(lost))
    known = set(target.names)
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in source if f.name not in known])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; absent ones are NULL."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*(
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in have
        else F.col(f"`{f.name}`") if have[f.name] == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
        for f in schema))
