"""Rendering of dates in delivered files (X-1 .. X-4, X-8, X-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three delivered date forms and the layout words that select
# them. A layout that says AAAAMMDD still delivers yyyy/MM/dd (the code wins).
YMD_SLASH = "yyyy/MM/dd"
DMY_SLASH = "dd/MM/yyyy"
YMD_DASH = "yyyy-MM-dd"
LAYOUT_FORMAT_WORDS = {
    "AAAA/MM/DD": YMD_SLASH,
    "DD/MM/AAAA": DMY_SLASH,
    "YYYY-MM-DD": YMD_DASH,
    "AAAA-MM-DD": YMD_DASH,
    "AAAAMMDD": YMD_SLASH,
}
DEFAULT_DATE_FORMAT = YMD_SLASH

# Short tags used in the layout text of ``periodica.layouts``.
FORMAT_TAGS = {"ymd": YMD_SLASH, "dmy": DMY_SLASH, "iso": YMD_DASH}

# Input forms accepted by the landing date conversion (S5), tried in order.
INPUT_DATE_FORMS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy")


def format_from_layout(text: str | None) -> str:
    """Pick the delivery pattern from the free text of a layout (X-4)."""
    if not text:
        return DEFAULT_DATE_FORMAT
    key = text.strip().upper()
    return LAYOUT_FORMAT_WORDS.get(key, DEFAULT_DATE_FORMAT)


def render_date(c: Column | str, pattern: str = DEFAULT_DATE_FORMAT) -> Column:
    """Date as text in ``pattern``; NULL stays NULL (X-1..X-3). The separator is
    literal, it does not follow any locale."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, pattern)


def render_ts_120(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp (X-8)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def parse_date_any(c: Column | str) -> Column:
    """Text to DATE in any accepted input form; NULL when none fits.

    The form is recognised by its shape and the text is rewritten to ISO
    order, so each cell is parsed exactly once with a plain string-to-date
    ``try_cast`` (trying every pattern in turn costs a failed parse per
    attempt). Impossible dates such as ``2026/13/01`` become NULL, so the
    caller can route the row to the rejects.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    parts = F.split(t, "/")
    dmy = F.concat_ws("-", F.element_at(parts, 3), F.element_at(parts, 2), F.element_at(parts, 1))
    iso = (F.when(t.rlike(r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$"), F.translate(t, "/", "-"))
           .when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), dmy))
    return iso.try_cast("date")


def compact_date(text: str) -> str:
    """'19000101' style literal to ISO text (X-22)."""
    s = text.strip()
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}"
