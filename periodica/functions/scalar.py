"""Scalar expressions that need care to give the legacy T-SQL results (X-5 .. X-20).

Each helper returns a built-in Spark Column expression, so everything stays in
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c: Column | str, width: int) -> Column:
    """Right ``width`` characters of ``'0'*width + text`` (X-5, V9).

    Not ``lpad``: a value longer than ``width`` keeps its right end
    (``'1234567' -> '234567'``), while ``lpad`` would keep the left end.
    """
    txt = _c(c).cast("string")
    return F.substring(F.concat(F.lit("0" * width), txt), -width, width)


def tsql_len(c: Column | str) -> Column:
    """Length ignoring trailing blanks (X-20, F9)."""
    return F.length(F.rtrim(_c(c).cast("string")))


def tsql_left(c: Column | str, n: int) -> Column:
    """First ``n`` characters (X-19, E13)."""
    return F.substring(_c(c).cast("string"), 1, n)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Whole second boundaries crossed from ``a`` to ``b`` (X-13)."""
    return (F.unix_timestamp(F.date_trunc("second", _c(b)))
            - F.unix_timestamp(F.date_trunc("second", _c(a))))


def concat_poisoned(*cols: Column | str) -> Column:
    """String ``+``: any NULL operand makes the whole result NULL (X-18)."""
    return F.concat(*[_c(c) for c in cols])


CRLF = "\r\n"
