"""Rows of the 23 report shapes, generated by rule (never copied): every
column gets a value of its declared kind that fits it, zero-led codes stay
text, dates come in the three input forms, and control dates span three
consecutive windows."""
from __future__ import annotations

import datetime as dt
import re

from periodica.functions.periods import window_for
from periodica.spec import LayoutColumn

FORMS = ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y")


def windows(day: dt.date, frequency: str, n: int = 3) -> list[dt.date]:
    """Start days of ``n`` consecutive windows beginning with the run day's."""
    out, w = [], window_for(day, frequency)
    for _ in range(n):
        out.append(w.start)
        w = window_for(w.end, frequency)
    return out


def value(col: LayoutColumn, i: int, day: dt.date, iso: bool = False) -> str:
    t = col.type
    if t.kind == "date":
        d = day + dt.timedelta(days=i % 5)
        return d.isoformat() if iso else d.strftime(FORMS[i % 3])
    if t.kind == "varchar":
        n = t.length
        return (f"{i + 1:06d}")[-n:] if n <= 6 else f"{col.name[:3]}{i:03d}"[:n]
    if t.kind == "text":
        return f"{col.name[:2]}{i:04d}"
    if t.kind == "numeric":
        whole = t.precision - t.scale
        ip = (i * 7 + 1) % (10 ** min(whole, 4)) if whole > 0 else 0
        return f"{ip}.{'5'.ljust(t.scale, '0')}" if t.scale else str(ip)
    if t.kind in ("int", "bigint"):
        return str(i)
    if t.kind == "bit":
        return "1" if i % 2 else "0"
    return f"x{i}"


def file_name(pattern: str) -> str:
    s = pattern.strip("^$").replace(r"\.xlsx?", ".xlsx").replace(r"\.csv", ".csv")
    s = s.replace(".*", "_20260615").replace("\\", "")
    assert re.match(pattern, s), (pattern, s)
    return s
