"""Column-level building blocks (projections P1-P19).

Every function returns a built-in ``Column`` expression or a frame transform,
so all of it stays inside whole-stage codegen; there is no Python per row.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote(name: str) -> str:
    """Backtick-quote a column name (names like ``.`` or ``Account No``)."""
    return "`" + name.replace("`", "``") + "`"


# --- frame transforms -------------------------------------------------------


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def clean_columns(df: DataFrame, drop: Iterable[str] = ()) -> DataFrame:
    """Drop columns by exact name (``drop`` takes names as-is, so a
    column called ``.`` needs no quoting)."""
    return df.drop(*[c for c in drop if c in df.columns])


# --- scalar expressions ------------------------------------------------------


def strip_chars(col: ColumnOrName, chars: str = "'") -> Column:
    """Remove every occurrence of the given characters."""
    return F.translate(_c(col), chars, "")


# Date texts accepted by default: what the workbook reader emits (a day, or a
# day with a time) and the text forms of bank exports; month first in slashes.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "d-MMM-yy",
    "d-MMM-yyyy",
    "M/d/yyyy",
)
_NUMBER_FIELDS = frozenset(["yyyy", "yy", "y", "MM", "M", "dd", "d", "HH", "H", "mm", "m", "ss", "s", "SSSSSS", "SSS"])
# Two-digit years up to this one are 20xx, later ones 19xx.
LAST_SHORT_YEAR = 68


def _shape(fmt: str) -> str:
    """A pattern that every text which a date format accepts fits: its literal characters in any case, signed
    digits for number fields, anything for other fields and optional parts."""
    if "[" in fmt:
        return ""
    out = []
    for part in re.finditer(r"'(?P<quoted>[^']*)'|(?P<field>([A-Za-z])\3*)|(?P<literal>.)", fmt):
        field = part["field"]
        if field is None:
            out.append(re.escape(part["literal"] or part["quoted"] or "'"))
        else:
            out.append("[-+0-9]+" if field in _NUMBER_FIELDS else ".+")
    return "(?is)^" + "".join(out) + "$"


def parse_date(col: ColumnOrName, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to DATE by the first format that accepts it; a value no format
    accepts becomes NULL (never raises, also under ANSI mode). Blanks around
    the text are ignored. A format is tried only on text of its shape: a failed
    try costs an exception. ISO days are cast."""
    c = F.trim(_c(col).cast("string"))

    def one(fmt: str) -> Column:
        day = F.when(c.rlike(_shape(fmt)), F.to_date(F.try_to_timestamp(c, F.lit(fmt))))
        if fmt == "yyyy-MM-dd":
            day = F.when(c.rlike(r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"), c.try_cast("date")).otherwise(day)
        if re.search(r"(?<!y)yy(?!y)", fmt):
            day = F.when(F.year(day) > 2000 + LAST_SHORT_YEAR, F.to_date(F.add_months(day, -1200))).otherwise(day)
        return day

    return F.coalesce(*[one(f) for f in formats])


def to_money(col: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Number or numeric text to ``decimal(precision, scale)``.

    The value is read as an exact decimal (18 digits after the point) and, only
    where that fails (``1.5e3`` beyond its range), as a double; it is rounded
    half-even. NaN, infinities, unparsable text and values too large for the
    target become NULL: nothing fails the job.
    """
    c = _c(col)
    target = T.DecimalType(precision, scale)
    exact = F.bround(c.try_cast(T.DecimalType(38, 18)), scale).try_cast(target)
    x = c.try_cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    return F.coalesce(exact, F.bround(finite, scale).try_cast(target))


def ntz_literal(ts: _dt.datetime | str) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on the Python or
    session time zone."""
    text = ts.isoformat(sep=" ") if isinstance(ts, _dt.datetime) else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def local_time(tz: str, now: _dt.datetime | str | None = None) -> Column:
    """Wall-clock time in ``tz`` as ``timestamp_ntz``.

    ``now`` is a UTC wall-clock time; when omitted the query start time is used.
    """
    if now is None:
        # current time as wall clock of the session zone, converted from it
        return F.convert_timezone(None, F.lit(tz), F.current_timestamp().cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz_literal(now))


def stamp_ingestion(
    df: DataFrame,
    column: str = "IngestionTime",
    tz: str = "Asia/Jakarta",
    now: _dt.datetime | str | None = None,
) -> DataFrame:
    """P10: add the load time in a named zone."""
    return df.withColumn(column, local_time(tz, now))


def fill_missing_date(col: ColumnOrName, default: _dt.date | str) -> Column:
    """Replace a missing date by an explicit default date."""
    d = default.isoformat() if isinstance(default, _dt.date) else str(default)
    return F.coalesce(_c(col), F.lit(d).cast("date"))


def to_float(col: ColumnOrName) -> Column:
    """Decimal to double (profiling input)."""
    return _c(col).cast("double")


def partition_date(primary: ColumnOrName, *fallbacks: ColumnOrName) -> Column:
    """First non-NULL DATE of the given date / timestamp columns."""
    return F.coalesce(*[F.to_date(_c(c)) for c in (primary, *fallbacks)])


def as_text(col: ColumnOrName) -> Column:
    """Text form used inside keys: dates as ``yyyy-MM-dd``, decimals with
    their full scale (``1.50``)."""
    return _c(col).cast("string")


def surrogate_key(
    cols: Sequence[ColumnOrName],
    sep: str = "",
    null_as: Mapping[str, str] | None = None,
) -> Column:
    """SHA-256 hex of the columns' text joined by ``sep``.

    A column listed in ``null_as`` is replaced by that text when NULL; any
    other NULL makes the whole key NULL (``concat`` semantics). With the
    default empty separator ("1","23") and ("12","3") collide, as in the
    original formula; pass a separator to avoid that.
    """
    null_as = dict(null_as or {})
    parts: list[Column] = []
    for i, c in enumerate(cols):
        text = as_text(c)
        if isinstance(c, str) and c in null_as:
            text = F.coalesce(text, F.lit(null_as[c]))
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(text)
    return F.sha2(F.concat(*parts), 256)


def sha256_hex(col: ColumnOrName) -> Column:
    """SHA-256 hex of one string."""
    return F.sha2(_c(col).cast("string"), 256)


def day_stamp(local_ts: ColumnOrName) -> Column:
    """``yyyyMMdd`` of a wall-clock timestamp."""
    return F.date_format(_c(local_ts), "yyyyMMdd")


def file_stem(path: ColumnOrName) -> Column:
    """Last path segment, lower case, cut at the first dot.

    Trailing slashes are ignored; an empty or NULL path gives ``unknown``.
    """
    p = F.regexp_replace(_c(path), "/+$", "")
    stem = F.lower(F.substring_index(F.substring_index(p, "/", -1), ".", 1))
    return F.when(_c(path).isNull() | (_c(path) == ""), F.lit("unknown")).otherwise(stem)


def lower_or_unknown(col: ColumnOrName) -> Column:
    """Lower case; NULL or empty text becomes ``unknown``."""
    c = _c(col)
    return F.when(c.isNull() | (c == ""), F.lit("unknown")).otherwise(F.lower(c))


def count_status(
    source: ColumnOrName, destination: ColumnOrName, zero_is_unknown: bool = True
) -> tuple[Column, Column]:
    """(difference, status) of two counts.

    PASS when equal, FAIL when not; UNKNOWN (difference NULL) when either is
    missing, or zero unless ``zero_is_unknown`` is False.
    """
    s, d = _c(source), _c(destination)
    unknown = s.isNull() | d.isNull()
    if zero_is_unknown:
        unknown = unknown | (s == 0) | (d == 0)
    diff = F.when(unknown, F.lit(None)).otherwise(s - d).cast("long")
    status = (
        F.when(unknown, F.lit("UNKNOWN"))
        .when(s == d, F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    return diff, status


# Texts that stand for a missing cell, so not a failed cast.
MISSING_TEXTS = ("", "nan", "nat", "none", "null")


def _typed(src: Column, have: T.DataType, want: T.DataType, date_formats: Sequence[str]) -> Column:
    if have == want:
        return src
    if isinstance(want, T.DateType) and isinstance(have, T.StringType):
        return parse_date(src, date_formats)
    if isinstance(want, T.DecimalType):
        money = to_money(src, want.precision, want.scale)
        whole = want.precision - want.scale
        if not isinstance(have, T.StringType) or not 1 <= whole <= 20 or want.scale > 18:
            return money
        # digits that fit need no rounding
        fits = rf"^-?[0-9]{{1,{whole}}}(\.[0-9]{{1,{want.scale}}})?$" if want.scale else rf"^-?[0-9]{{1,{whole}}}$"
        return F.when(src.rlike(fits), src.try_cast(want)).otherwise(money)
    return src.try_cast(want)


def lost_cell(src: Column, typed: Column) -> Column:
    """Whether a cell holds a value that typing made NULL; NULL, blank, ``NaN`` and the like are missing, not lost."""
    text = F.lower(F.trim(src.cast("string")))
    return typed.isNull() & src.isNotNull() & ~text.isin(*MISSING_TEXTS)


def conform(
    df: DataFrame,
    schema: T.StructType,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Select the schema's fields in order with its types.

    Text to DATE goes through ``parse_date``; decimals through ``to_money``;
    everything else through ``try_cast``, so a bad value becomes NULL rather
    than failing the job (``cast_failures`` counts them). NULL stays NULL (no
    ``'nan'`` / ``'None'`` text). Missing fields are added as NULL.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name in types:
            expr = _typed(F.col(quote(f.name)), types[f.name], f.dataType, date_formats)
        else:
            expr = F.lit(None).cast(f.dataType)
        out.append(expr.alias(f.name))
    return df.select(*out)


def cast_failures(
    df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = DATE_FORMATS
) -> dict[str, Column]:
    """P5: per field, an aggregate counting the cells that hold a value which
    ``conform`` turns into NULL. Missing cells (NULL, blank, ``NaN`` and the
    like) are not failures. Use it in ``agg`` or ``observe`` on the same frame."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for f in schema.fields:
        if f.name in types:
            src = F.col(quote(f.name))
            typed = _typed(src, types[f.name], f.dataType, date_formats)
            out[f.name] = F.count_if(lost_cell(src, typed))
        else:
            out[f.name] = F.lit(0).cast("long")
    return out


def conform_counted(
    df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = DATE_FORMATS
) -> tuple[DataFrame, dict[str, Column]]:
    """``conform`` and ``cast_failures`` with every cell typed once: the schema's fields, followed by columns that
    mark the cells which typing lost, and the aggregates over that frame."""
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = [f for f in schema.fields if f.name in types and types[f.name] != f.dataType]
    stem = "__cell"
    while any(n.startswith(stem) for n in schema.names):
        stem = f"_{stem}"
    cells = {f.name: f"{stem}{i}" for i, f in enumerate(typed)}
    wide = df.select("*", *[F.col(quote(n)).alias(c) for n, c in cells.items()])
    kept = [T.StructField(c, types[n]) for n, c in cells.items()]
    out = conform(wide, T.StructType([*schema.fields, *kept]), date_formats)
    out = out.select(*[F.col(quote(n)) for n in schema.names], *[lost_cell(F.col(c), F.col(quote(n))).alias(c) for n, c in cells.items()])
    return out, {f.name: F.count_if(F.col(cells[f.name])) if f.name in cells else F.lit(0).cast("long") for f in schema.fields}
