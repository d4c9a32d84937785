"""Declared column types: parsing, Spark types and "does the value fit" checks (V2).

Layout types are the T-SQL declarations (``varchar(n)``, ``numeric(p,s)``,
``date``, ``int``, ``bit``) plus two kinds for reports whose tables have no declared
DDL: ``text`` (string, no length limit) and ``number``
(``decimal(18,6)``, our choice).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER_DEFAULT = (18, 6)

_TYPE_RE = re.compile(r"^(varchar|nvarchar|numeric|decimal|date|datetime|smalldatetime|"
                      r"int|bigint|bit|text|number)(?:\((\d+)(?:,(\d+))?\))?$")


@dataclass(frozen=True)
class ColType:
    kind: str            # varchar | numeric | date | timestamp | int | bigint | bit | text
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def spark(self) -> T.DataType:
        if self.kind in ("varchar", "text"):
            return T.StringType()
        if self.kind == "numeric":
            return T.DecimalType(self.precision, self.scale)
        if self.kind == "date":
            return T.DateType()
        if self.kind == "timestamp":
            return T.TimestampNTZType()
        if self.kind == "int":
            return T.IntegerType()
        if self.kind == "bigint":
            return T.LongType()
        if self.kind == "bit":
            return T.BooleanType()
        raise ValueError(self.kind)

    @property
    def ddl(self) -> str:
        """Type text for CREATE TABLE; VARCHAR(n) keeps the declared length."""
        if self.kind == "varchar":
            return f"VARCHAR({self.length})"
        return self.spark.simpleString().upper()

    @property
    def sql_name(self) -> str:
        """The declaration in T-SQL words, used in schema diffs (V3)."""
        if self.kind == "varchar":
            return f"varchar({self.length})"
        if self.kind == "numeric":
            return f"numeric({self.precision},{self.scale})"
        return self.kind

    def __str__(self) -> str:
        return self.sql_name


def parse_type(text: str) -> ColType:
    t = text.strip().lower().replace(" ", "")
    m = _TYPE_RE.match(t)
    if not m:
        raise ValueError(f"unknown type {text!r}")
    kind, a, b = m.group(1), m.group(2), m.group(3)
    if kind in ("varchar", "nvarchar"):
        return ColType("varchar", length=int(a)) if a else ColType("text")
    if kind in ("numeric", "decimal"):
        return ColType("numeric", precision=int(a or 18), scale=int(b or 0))
    if kind == "number":
        p, s = NUMBER_DEFAULT
        return ColType("numeric", precision=p, scale=s)
    if kind in ("datetime", "smalldatetime"):
        return ColType("timestamp")
    return ColType(kind)


def spark_type_to_coltype(dtype: T.DataType) -> ColType:
    """Best description of an existing Spark column in layout terms."""
    if isinstance(dtype, T.CharType | T.VarcharType):
        return ColType("varchar", length=dtype.length)
    if isinstance(dtype, T.StringType):
        return ColType("text")
    if isinstance(dtype, T.DecimalType):
        return ColType("numeric", precision=dtype.precision, scale=dtype.scale)
    if isinstance(dtype, T.DateType):
        return ColType("date")
    if isinstance(dtype, T.TimestampType | T.TimestampNTZType):
        return ColType("timestamp")
    if isinstance(dtype, T.IntegerType | T.ShortType | T.ByteType):
        return ColType("int")
    if isinstance(dtype, T.LongType):
        return ColType("bigint")
    if isinstance(dtype, T.BooleanType):
        return ColType("bit")
    if isinstance(dtype, T.DoubleType | T.FloatType):
        return ColType("numeric", precision=38, scale=18)
    return ColType("text")


def typed(c: Column | str, t: ColType) -> Column:
    """Convert to the declared type without failing the job: a value that does
    not convert or does not fit becomes NULL (``try_cast``). Excess scale rounds
    half up, excess precision becomes NULL; text is never truncated here."""
    c = F.col(c) if isinstance(c, str) else c
    if t.kind in ("varchar", "text"):
        return c.cast("string")
    return c.try_cast(t.spark)


def misfit(c: Column | str, t: ColType, source: T.DataType | None = None) -> Column:
    """TRUE when a non-NULL value would not store in the declared type (V2):
    text longer than the length (trailing blanks ignored, as the server trims
    them), a number that does not convert or overflows the precision, a date
    that does not parse.

    With the source column's type known, the check skips conversions that can
    never fail (a date or timestamp into a date, an integer into a wide enough
    integer) and tests floating-point values against the precision bound with a
    plain comparison; only values within a rounding step of the bound (and
    NaN / infinity) take the exact decimal conversion.
    """
    c = F.col(c) if isinstance(c, str) else c
    if t.kind == "varchar":
        return c.isNotNull() & (F.length(F.rtrim(c.cast("string"))) > t.length)
    if t.kind == "text":
        return F.lit(False)
    if source is not None:
        if t.kind == "date" and isinstance(source, T.DateType | T.TimestampType | T.TimestampNTZType):
            return F.lit(False)
        if t.kind == "bigint" and isinstance(source, T.LongType | T.IntegerType | T.ShortType | T.ByteType):
            return F.lit(False)
        if t.kind == "int" and isinstance(source, T.IntegerType | T.ShortType | T.ByteType):
            return F.lit(False)
        if t.kind == "numeric" and isinstance(source, T.DoubleType | T.FloatType):
            bound = 10.0 ** (t.precision - t.scale)
            step = 10.0 ** (-t.scale)
            a = F.abs(c)
            exact = c.try_cast(t.spark).isNull()
            return c.isNotNull() & (F.when(a < F.lit(bound - step), F.lit(False))
                                    .when(a > F.lit(bound + step), F.lit(True))
                                    .otherwise(exact))
    return c.isNotNull() & c.try_cast(t.spark).isNull()


def sql_misfit(col: str, t: ColType) -> str:
    """The same check as DuckDB SQL text (used by the oracle queries)."""
    if t.kind == "varchar":
        return f"({col} IS NOT NULL AND length(rtrim(CAST({col} AS VARCHAR))) > {t.length})"
    if t.kind == "text":
        return "FALSE"
    target = {"numeric": f"DECIMAL({t.precision},{t.scale})", "date": "DATE",
              "int": "INTEGER", "bigint": "BIGINT", "bit": "BOOLEAN",
              "timestamp": "TIMESTAMP"}[t.kind]
    return f"({col} IS NOT NULL AND TRY_CAST({col} AS {target}) IS NULL)"
