"""Schema changes by column: what a table may become.

A new schema is reconciled with the table's: columns it adds come last,
columns it lacks stay (their new values are null), a type may widen without
loss, and everything else is refused.  Names are compared as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# wider types that hold every value of a type and that Parquet files of the
# narrower type can be read as
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType),
    T.ShortType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


class SchemaChangeError(ValueError):
    pass


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds both, ``old`` or a wider one; None where neither
    holds the other or the kind would change."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        holds = lambda a, b: a.scale >= b.scale and a.precision - a.scale >= b.precision - b.scale
        return new if holds(new, old) else old if holds(old, new) else None
    if type(new) in WIDER.get(type(old), ()):
        return new
    if type(old) in WIDER.get(type(new), ()):  # narrower values are cast up
        return old
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = widened(old.elementType, new.elementType)
        return T.ArrayType(inner) if inner is not None else None
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        try:
            return reconcile(old, new)
        except SchemaChangeError:
            return None
    return None


def reconcile(old: T.StructType, new: T.StructType) -> T.StructType:
    """The table's schema after rows of ``new`` join it; raises
    ``SchemaChangeError`` naming every column that cannot."""
    incoming = {f.name: f for f in new}
    fields, refused = [], []
    for f in old:
        other = incoming.pop(f.name, None)
        kind = f.dataType if other is None else widened(f.dataType, other.dataType)
        if kind is None:
            refused.append(f"{f.name}: {f.dataType.simpleString()} to {other.dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind or f.dataType, True))
    if refused:
        raise SchemaChangeError(f"columns would lose values or change kind: {'; '.join(refused)}")
    void = [n for n, f in incoming.items() if isinstance(f.dataType, T.NullType)]
    if void:
        raise SchemaChangeError(f"new columns without a type: {', '.join(void)}")
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in incoming.values()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns of ``schema``: missing ones null, types cast up."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (F.lit(None).cast(f.dataType) if f.name not in have
         else F.col(f"`{f.name}`") if have[f.name] == f.dataType else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name)
        for f in schema])
