"""Landing and report tables: Parquet tables in the Spark catalog.

Report tables are partitioned by ``period_start`` (first day of the report's
period), so replacing one window is a static overwrite of one partition and
delivering one window reads one partition (partition pruning). Landing tables
are append-only and partitioned by the month of the control date; a window load
prunes to the one or two months its window touches and pushes the sargable
range on the control column into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.periods import Window, in_window, overlapping_periods
from periodica.session import LOCATION_SUFFIX, path_exists, read_lines, shared_path
from periodica.sources.versions import forget_windows, partition_location, sync_windows, table_location
from periodica.spec import LANDING_PART_COL, PERIOD_COL, SOURCE_FILE_COL, IngestSpec, ReportSpec

BRONZE, SILVER = "bronze", "silver"
NOT_NULL = "periodica.not_null"     # table property: the columns that must not be NULL
LANDING_CONTROL = "periodica.landing.control"   # table property: column behind landing_month


def _q(name: str) -> str:
    return f"`{name}`"


def _ddl_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.VarcharType):
        return f"VARCHAR({dtype.length})"
    return dtype.simpleString().upper()


class Lake:
    """Catalog schemas ``bronze`` (landing) and ``silver`` (reports) under one root.

    With a shared metastore the definitions persist; with the in-memory catalog
    (local runs) ``ensure_*`` re-attaches existing folders, recovers their
    partitions and lets windows follow their commits (``sources.versions``), so a new
    session sees the data written by an earlier one.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = ""):
        self.spark = spark
        self.root = (root or shared_path(spark, "periodica", "lake")).rstrip("/")
        self.prefix = prefix
        for layer in (BRONZE, SILVER):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db(layer)} "
                      f"LOCATION '{self.root}/{self.db(layer)}'")

    def db(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def location(self, layer: str, table: str) -> str:
        """Folder of a table: where its last migration put it, else the standard one."""
        standard = f"{self.root}/{self.db(layer)}/{table}"
        return next(iter(read_lines(self.spark, standard + LOCATION_SUFFIX)), standard)

    def fq(self, layer: str, table: str) -> str:
        return f"{self.db(layer)}.{table}"

    # -- creation (E17) -------------------------------------------------------
    def ensure_table(self, layer: str, table: str, schema: T.StructType,
                     partitioned: bool = True, types: dict[str, str] | None = None,
                     partition_col: str = PERIOD_COL,
                     properties: dict[str, str] | None = None) -> str:
        """CREATE TABLE IF NOT EXISTS with a declared schema; returns its name."""
        fq = self.fq(layer, table)
        loc = self.location(layer, table)
        existed = path_exists(self.spark, loc)
        types = types or {}
        cols = ", ".join(f"{_q(f.name)} {types.get(f.name, _ddl_type(f.dataType))}"
                         for f in schema.fields if f.name != partition_col)
        part = ""
        if partitioned:
            cols += f", {partition_col} DATE"
            part = f" PARTITIONED BY ({partition_col})"
        props = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
        props = f" TBLPROPERTIES ({props})" if props else ""
        if not self.spark.catalog.tableExists(fq):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {fq} ({cols}) USING parquet"
                           f"{part} LOCATION '{loc}'{props}")
            if partitioned and existed:
                self.spark.sql(f"ALTER TABLE {fq} RECOVER PARTITIONS")
            forget_windows(self.spark, fq)
        return fq

    def ensure_report_table(self, spec: ReportSpec) -> str:
        types = {c.name: c.type.ddl for c in spec.stored_columns}
        held = sorted(c.name for c in spec.stored_columns if not c.nullable)
        fq = self.ensure_table(SILVER, spec.table, spec.stored_schema(), True, types, properties={NOT_NULL: ",".join(held)})
        sync_windows(self.spark, fq, table_location(self.spark, fq))
        return fq

    def report(self, spec: ReportSpec) -> DataFrame:
        """A report table as it was last committed, by this session or another."""
        fq = self.report_table(spec)
        self.require(fq)
        sync_windows(self.spark, fq, table_location(self.spark, fq))
        return self.spark.table(fq)

    def ensure_landing_table(self, spec: IngestSpec) -> str:
        """Append-only landing table, partitioned by the month of each row's
        control date (load month when the source has none), so a window load
        lists and reads only the months its window touches."""
        schema = T.StructType(spec.landing_schema().fields
                              + [T.StructField(SOURCE_FILE_COL, T.StringType())])
        return self.ensure_table(BRONZE, spec.landing_table, schema, True,
                                 partition_col=LANDING_PART_COL,
                                 properties={LANDING_CONTROL: spec.control_col or ""})

    def landing_control(self, fq: str) -> str | None:
        """The column by whose month a landing table is partitioned; None when
        that is the load time, so that months say nothing about a window."""
        row = self.spark.sql(f"SHOW TBLPROPERTIES {fq}").where(F.col("key") == LANDING_CONTROL).first()
        return (row["value"] or None) if row else None

    def relayout(self, spec: ReportSpec) -> str:
        """Let a report table take another layout without rewriting it (E8): the definition
        is made anew over the same folders. Windows loaded from now on have the new
        layout; those before keep theirs in their files, and are read by name: a column
        that the new layout drops is not shown, one that it adds is NULL. ``window_as``
        still reads them under the layout they were loaded by."""
        fq = self.report_table(spec)
        self.require(fq)
        self.spark.sql(f"DROP TABLE {fq}")
        forget_windows(self.spark, fq)
        return self.ensure_report_table(spec)

    def window_as(self, spec: ReportSpec, window: Window) -> DataFrame:
        """A stored window under the layout of ``spec``, which may be an earlier one."""
        fq = self.report_table(spec)
        sync_windows(self.spark, fq, table_location(self.spark, fq))
        folder = partition_location(self.spark, fq, window.start)
        if folder is None:
            return self.spark.createDataFrame([], spec.stored_schema())
        return self.spark.read.schema(spec.stored_schema()).parquet(folder)

    def report_table(self, spec: ReportSpec) -> str:
        return self.fq(SILVER, spec.table)

    def exists(self, fq: str) -> bool:
        return self.spark.catalog.tableExists(fq)

    def require(self, fq: str) -> None:
        """Preflight: abort when the target table is missing."""
        if not self.exists(fq):
            raise LookupError(f"table {fq} does not exist")

    def drop(self, fq: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {fq}")


def scan_window(df: DataFrame, control: str, window: Window,
                partitioned: bool = False) -> DataFrame:
    """Rows of one window (S12). On a report table the partition filter keeps the
    folders that overlap the window, also when the table is stored by another
    frequency; the range on the control column is pushed to Parquet."""
    if partitioned:
        df = df.where(overlapping_periods(PERIOD_COL, window))
    return df.where(in_window(control, window))


def window_has_rows(df: DataFrame) -> bool:
    """EXISTS guard (F7): reads at most one row."""
    return not df.limit(1).isEmpty()
