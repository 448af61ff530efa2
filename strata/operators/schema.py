"""Types and names of columns that come from two sides (W6): what one type holds of another
without loss, the narrowest type that holds both, and names as the session resolves them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote

#: Decimal digits of the whole-number types, narrowest first.
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def free_name(stem: str, *taken: Iterable[str]) -> str:
    """A column name from ``stem`` that none of the given lists holds, in whatever case."""
    held, name = {c.lower() for names in taken for c in names}, stem
    while name.lower() in held:
        name = f"_{name}"
    return name


def lossless(have: T.DataType, want: T.DataType) -> bool:
    """Whether ``want`` holds every value of ``have`` exactly. Text holds every plain value; NULLs fit anywhere."""
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return lossless(have.elementType, want.elementType)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return have.keyType == want.keyType and lossless(have.valueType, want.valueType)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return have.names == want.names and all(lossless(a.dataType, b.dataType) for a, b in zip(have, want, strict=True))
    if isinstance(want, T.StringType):
        return isinstance(have, T.AtomicType) and not isinstance(have, (T.BinaryType, T.VariantType))
    if have in DIGITS:
        if want in DIGITS:
            return DIGITS[have] <= DIGITS[want]
        if isinstance(want, T.DecimalType):
            return DIGITS[have] <= want.precision - want.scale
        return isinstance(want, T.DoubleType) and DIGITS[have] <= 10 or isinstance(want, T.FloatType) and DIGITS[have] <= 5
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    if isinstance(have, T.FloatType):
        return isinstance(want, T.DoubleType)
    return isinstance(have, T.DateType) and isinstance(want, T.TimestampNTZType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly; None if there is none. Text and another type have
    none: a typed column does not become text because the other side is text."""
    if T.StringType() in (a, b) and a != b and not {type(a), type(b)} & {T.NullType}:
        return None
    if lossless(a, b):
        return b
    if lossless(b, a):
        return a
    if {type(a), type(b)} <= {T.FloatType, T.IntegerType}:
        return T.DoubleType()
    scales = [x.scale if isinstance(x, T.DecimalType) else 0 if x in DIGITS else None for x in (a, b)]
    if None in scales:
        return None
    whole = max(x.precision - x.scale if isinstance(x, T.DecimalType) else DIGITS[x] for x in (a, b))
    return T.DecimalType(whole + max(scales), max(scales)) if whole + max(scales) <= 38 else None


def merged_type(name: str, table: T.DataType, batch: T.DataType) -> T.DataType:
    """The type a table's column must have to take a batch (a text column takes any plain value); TypeError when
    nothing holds both without loss."""
    kind = table if lossless(batch, table) else common_type(batch, table)
    if kind is None:
        raise TypeError(f"column {name}: {batch.simpleString()} and {table.simpleString()} have no common type without loss; type the batch first")
    return kind


def resolves_case(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def match_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame with every column that the session resolves to one of ``names`` spelt like it."""
    if resolves_case(df.sparkSession):
        return df
    spelt = {n.lower(): n for n in names}
    renamed = {c: spelt[c.lower()] for c in df.columns if spelt.get(c.lower(), c) != c}
    return df.select(*[F.col(quote(c)).alias(renamed.get(c, c)) for c in df.columns]) if renamed else df


def spelt_like(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names as the frame spells them."""
    if resolves_case(df.sparkSession):
        return list(names)
    spelt = {c.lower(): c for c in df.columns}
    return [spelt.get(n.lower(), n) for n in names]
