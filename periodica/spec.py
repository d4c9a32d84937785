"""Report and ingestion specs: the declarative description every job works from."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from periodica.functions.formats import FORMAT_TAGS
from periodica.functions.periods import FREQUENCIES
from periodica.functions.types import ColType, parse_type

# Audit columns every landing and report table carries; never delivered.
ID_COL = "ID"
LOAD_TS_COL = "FECHA_EXTRACCION"
PERIOD_COL = "period_start"
SOURCE_FILE_COL = "source_file"
LANDING_PART_COL = "landing_month"   # landing partition: month of the control date


@dataclass(frozen=True)
class LayoutColumn:
    name: str                 # stored name, case-exact
    type: ColType
    nullable: bool = False
    out: str | None = None    # delivered header when it differs from ``name``
    fmt: str | None = None    # delivery date pattern; None = value as stored

    @property
    def header(self) -> str:
        return self.out or self.name


def parse_layout(text: str) -> tuple[LayoutColumn, ...]:
    """Parse the compact layout text of ``periodica.layouts``.

    One column per ``|``-separated item: ``NAME type [ymd|dmy|iso] [?] [>HEADER]``.
    """
    cols = []
    for item in text.split("|"):
        toks = item.split()
        if not toks:
            continue
        name, typ, rest = toks[0], toks[1], toks[2:]
        fmt, nullable, out = None, False, None
        for t in rest:
            if t in FORMAT_TAGS:
                fmt = FORMAT_TAGS[t]
            elif t == "?":
                nullable = True
            elif t.startswith(">"):
                out = t[1:]
            else:
                raise ValueError(f"bad layout token {t!r} in {item!r}")
        cols.append(LayoutColumn(name, parse_type(typ), nullable, out, fmt))
    return tuple(cols)


@dataclass(frozen=True)
class ReportSpec:
    """One regulatory report: stored table, load rule and delivered layout."""

    numero: int
    name: str
    frequency: str
    control: str
    columns: tuple[LayoutColumn, ...]          # delivered layout, in order
    hidden: tuple[LayoutColumn, ...] = ()      # stored but never delivered
    source: str = "landing"                    # landing | self
    landing: str | None = None                 # landing table (bronze)
    load_renames: tuple[tuple[str, str], ...] = ()   # landing name -> stored name
    inject: str = "none"                       # none | run_day | period_start
    inject_col: str | None = None
    sort: tuple[str, ...] = ()
    version: str = "current"
    active: bool = True
    file_name: str | None = None
    delete_on: str | None = None     # a load deletes by this column instead of the control column

    def __post_init__(self):
        if self.frequency not in FREQUENCIES:
            raise ValueError(self.frequency)
        names = [c.name for c in self.stored_columns]
        if self.control not in names and self.control != LOAD_TS_COL:
            raise ValueError(f"{self.name}: control {self.control} not stored")

    @property
    def table(self) -> str:
        """Catalog-safe table name: names that begin with a digit get an ``r``."""
        return "r" + re.sub(r"[^0-9a-z]+", "_", self.name.lower()).strip("_")

    @property
    def stored_columns(self) -> tuple[LayoutColumn, ...]:
        return self.columns + self.hidden

    @property
    def control_column(self) -> LayoutColumn:
        for c in self.stored_columns:
            if c.name == self.control:
                return c
        return LayoutColumn(LOAD_TS_COL, ColType("timestamp"))

    def stored_schema(self) -> T.StructType:
        """Report table schema: audit ID, layout columns, hidden columns, load
        timestamp; ``period_start`` is the partition column."""
        fields = [T.StructField(ID_COL, T.StringType(), False)]
        seen = {ID_COL}
        for c in self.stored_columns:
            if c.name not in seen:
                fields.append(T.StructField(c.name, c.type.spark, c.nullable))
                seen.add(c.name)
        if LOAD_TS_COL not in seen:
            fields.append(T.StructField(LOAD_TS_COL, T.TimestampNTZType(), False))
        return T.StructType(fields)

    def with_version(self, **changes) -> "ReportSpec":
        return replace(self, **changes)


@dataclass(frozen=True)
class IngestSpec:
    """How files of one source are routed, read, typed and appended to landing."""

    name: str
    file_pattern: str
    landing: str
    column_map: tuple[tuple[str, str], ...]        # file header -> landing column
    date_fields: tuple[str, ...] = ()
    numeric_fields: tuple[tuple[str, str], ...] = ()   # landing column -> type text
    text_fields: tuple[tuple[str, int], ...] = ()      # landing column -> max length
    allow_empty: bool = True
    final_columns: tuple[str, ...] = ()
    file_type: str = "csv"                          # csv | excel
    delimiter: str = "|"
    encoding: str = "utf-8"
    enabled: bool = True
    generate_id: bool = True
    control_from: str = "column"                    # column | run_date
    control_col: str | None = None
    unmapped: tuple[str, ...] = field(default_factory=tuple)

    @property
    def landing_table(self) -> str:
        return "l_" + re.sub(r"[^0-9a-z]+", "_", self.landing.lower()).strip("_")

    def landing_schema(self) -> T.StructType:
        """Landing table schema in final column order."""
        num = dict(self.numeric_fields)
        fields = []
        final = list(self.final_columns)
        if (self.control_from == "run_date" and self.control_col
                and self.control_col not in final):
            final.insert(len(final) - 1 if final and final[-1] == LOAD_TS_COL else len(final),
                         self.control_col)
        for c in final:
            if c == ID_COL:
                fields.append(T.StructField(c, T.StringType(), False))
            elif c == LOAD_TS_COL:
                fields.append(T.StructField(c, T.TimestampNTZType(), False))
            elif c in self.date_fields or c == self.control_col and c not in num:
                fields.append(T.StructField(c, T.DateType(), True))
            elif c in num:
                fields.append(T.StructField(c, parse_type(num[c]).spark, True))
            else:
                fields.append(T.StructField(c, T.StringType(), True))
        return T.StructType(fields)

    @staticmethod
    def from_json(text: str, types: dict[str, str] | None = None, control_col: str | None = None,
                  control_from: str = "column") -> "IngestSpec":
        """Read a processor config in the JSON shape of the existing processor configs
        (``processor_name``, ``file_pattern``, ``read_options``, ``data_mapping``,
        ``db_config``). Numeric targets come from ``types`` (landing DDL) and
        default to ``numeric(18,6)``. The configs do not name the control column
        of the report they feed: ``control_col`` does, so that landing is
        partitioned by its month (else by load month)."""
        j = json.loads(text)
        dm = j.get("data_mapping", {})
        tc = dm.get("type_conversions", {})
        ro = j.get("read_options", {})
        db = j.get("db_config", {})
        types = types or {}
        cmap = tuple((k, v) for k, v in dm.get("column_map", {}).items())
        return IngestSpec(
            name=j.get("processor_name", db.get("table_name", "")),
            file_pattern=j["file_pattern"],
            landing=f"{db.get('schema', 'LMDA')}.{db.get('table_name', '')}",
            column_map=cmap,
            date_fields=tuple(tc.get("date_fields", [])),
            numeric_fields=tuple((c, types.get(c, "numeric(18,6)"))
                                 for c in tc.get("numeric_fields", [])),
            allow_empty=bool(tc.get("allow_empty", True)),
            final_columns=tuple(dm.get("final_db_columns", [])),
            file_type=(j.get("file_type") or ("excel" if "sheet_name" in ro else
                       ("csv" if "delimiter" in ro else "excel"))),
            delimiter=ro.get("delimiter", "|"),
            encoding=ro.get("encoding", "utf-8"),
            enabled=bool(j.get("enabled", True)),
            generate_id=bool(dm.get("generate_uuid_if_id_missing", True)),
            control_col=control_col, control_from=control_from,
        )
