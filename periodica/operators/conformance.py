"""Row-level conformance to a declared layout (V1, V2) as Column expressions.

``violation_reason`` gives one text per row naming every broken rule, so a
single pass can both count violations (``Observation``) and write the bad rows
to quarantine. Column-level summaries live in ``periodica.operators.quality``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodica.functions.types import ColType, misfit
from periodica.spec import LayoutColumn


def rule_checks(cols: Iterable[LayoutColumn], source_names: dict[str, str] | None = None,
                source_types: dict | None = None) -> list[tuple[str, Column]]:
    """(rule label, TRUE-when-broken) for every column: NULL in a mandatory
    column (V1) and a value that does not fit the declared type (V2)."""
    source_names = source_names or {}
    source_types = source_types or {}
    out = []
    for c in cols:
        name = source_names.get(c.name, c.name)
        src = F.col(name)
        if not c.nullable:
            out.append((f"{c.name}:null", src.isNull()))
        if c.type.kind not in ("text",):
            out.append((f"{c.name}:{c.type.sql_name}", misfit(src, c.type, source_types.get(name))))
    return out


def violation_reason(cols: Iterable[LayoutColumn],
                     source_names: dict[str, str] | None = None,
                     source_types: dict | None = None) -> Column:
    """';'-joined labels of the broken rules; empty string when the row conforms."""
    checks = rule_checks(cols, source_names, source_types)
    if not checks:
        return F.lit("")
    return F.concat_ws(";", *[F.when(cond, F.lit(label)) for label, cond in checks])


def conform(cols: Iterable[LayoutColumn], source_names: dict[str, str] | None = None
            ) -> list[Column]:
    """Projection to the declared types; a misfit becomes NULL (and is already
    flagged by ``violation_reason``)."""
    from periodica.functions.types import typed
    source_names = source_names or {}
    return [typed(F.col(source_names.get(c.name, c.name)), c.type).alias(c.name) for c in cols]


def layout_column(name: str, type_text: str, nullable: bool = True) -> LayoutColumn:
    from periodica.functions.types import parse_type
    return LayoutColumn(name, parse_type(type_text), nullable)


__all__ = ["rule_checks", "violation_reason", "conform", "layout_column", "ColType"]
