"""File -> landing ingestion driven by an ``IngestSpec`` (S4 .. S11).

One pass over the files computes the typed landing row and a rejection reason
per row and stages both kinds; accepted rows then move into the landing table. The
load timestamp is a literal fixed on the driver, so a retried task writes the same
value. Any number of runs may offer the same files at once (``sources.claims``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.formats import parse_date_any
from periodica.functions.types import parse_type
from periodica.session import delete_path, full_path, list_path, move_path
from periodica.sources.appends import append_run, ensure_runs_table, find_runs
from periodica.sources.claims import Claim, claim_files, close_claim, end_run, published_facts, publishing
from periodica.sources.files import CORRUPT_COL, scan_delimited, scan_workbook
from periodica.sources.tables import BRONZE, Lake
from periodica.sources.versions import table_location
from periodica.spec import ID_COL, LANDING_PART_COL, LOAD_TS_COL, SOURCE_FILE_COL, IngestSpec

REASON_COL = "_reason"
EXCEL_EPOCH = dt.date(1899, 12, 30)   # day 0 of workbook date serials
MANIFEST = "landed_files"
REJECTS = "rejects"

REJECTED_COL = "_rejected"

# a row for each landed file; counts are those of the file's batch (per-file counts are a
# grouped query on the landing's source_file column)
MANIFEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("spec", T.StringType()),
    T.StructField("batch_rows", T.LongType()), T.StructField("batch_rejected", T.LongType()),
    T.StructField("landed_at", T.TimestampNTZType()),
])


@dataclass
class IngestResult:
    spec: str
    accepted: int = 0
    rejected: int = 0
    files: list[str] = field(default_factory=list)
    skipped: int = 0                                        # files that have landed, or that another run is landing
    bad_files: dict[str, list[str]] = field(default_factory=dict)  # missing headers


def load_timestamp(now: dt.datetime | None = None) -> dt.datetime:
    """Load time rounded to the nearest minute (S13); computed once per batch on
    the driver and used as a literal, so every row of a batch carries the same
    value even when tasks are retried."""
    now = now or dt.datetime.now()
    now = now + dt.timedelta(seconds=30)
    return now.replace(second=0, microsecond=0)


def _clean(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def convert(df: DataFrame, spec: IngestSpec, loaded_at: dt.datetime,
            run_date: dt.date | None = None) -> DataFrame:
    """Column map (S4), date / numeric conversion (S5, S6), empty-cell rule (S7),
    IDs (S8) and final projection (S9), plus ``_reason`` for rejected rows."""
    nums = dict(spec.numeric_fields)
    texts = dict(spec.text_fields)
    out, checks = {}, []
    for src, dst in spec.column_map:
        raw = _clean(src) if src in df.columns else F.lit(None).cast("string")
        if dst in spec.date_fields:
            val = parse_date_any(raw)
            if spec.file_type == "excel":
                # workbook date cells arrive as day serials (days since 1899-12-30)
                serial = F.when(raw.rlike(r"^\d{1,6}(\.0+)?$"),
                                F.date_add(F.lit(EXCEL_EPOCH), raw.try_cast("double").cast("int")))
                val = F.coalesce(val, serial)
            checks.append((raw.isNotNull() & val.isNull(), f"{dst}:date"))
        elif dst in nums:
            t = parse_type(nums[dst])
            val = F.replace(raw, F.lit(","), F.lit("")).try_cast(t.spark)
            checks.append((raw.isNotNull() & val.isNull(), f"{dst}:{t.sql_name}"))
        else:
            val = raw
            if dst in texts:
                checks.append((F.length(F.rtrim(raw)) > texts[dst], f"{dst}:varchar({texts[dst]})"))
        if not spec.allow_empty:
            checks.append((raw.isNull(), f"{dst}:empty"))
        out[dst] = val
    if spec.control_from == "run_date" and spec.control_col and run_date is not None:
        out[spec.control_col] = F.lit(run_date)
    if CORRUPT_COL in df.columns:
        checks.append((F.col(CORRUPT_COL).isNotNull(), "line:malformed"))
    id_col = (F.coalesce(_clean(ID_COL), F.expr("uuid()")) if ID_COL in df.columns
              else F.expr("uuid()"))
    reason = F.concat_ws(";", *[F.when(cond, F.lit(label)) for cond, label in checks]) \
        if checks else F.lit("")
    ctrl = out.get(spec.control_col) if spec.control_col else None
    month = F.trunc(ctrl if ctrl is not None else F.lit(loaded_at).cast("date"), "month")
    return df.select(id_col.alias(ID_COL), *[v.alias(k) for k, v in out.items()],
                     F.lit(loaded_at).cast("timestamp_ntz").alias(LOAD_TS_COL),
                     F.regexp_replace(SOURCE_FILE_COL, "^file:/+", "file:/").alias(SOURCE_FILE_COL),
                     reason.alias(REASON_COL),
                     month.alias(LANDING_PART_COL))


def _manifest(spark: SparkSession, lake: Lake) -> str:
    table = lake.fq(BRONZE, MANIFEST)
    ensure_runs_table(spark, table, MANIFEST_SCHEMA)
    return table


def landed_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """Manifest of landed files (one row per file)."""
    return find_runs(spark, _manifest(spark, lake))


def claim(spark: SparkSession, lake: Lake, spec: IngestSpec, offered: DataFrame) -> Claim | None:
    """Claim the offered files (path) that have not landed and that no other run is landing."""
    def done() -> DataFrame:
        return landed_files(spark, lake).where(F.col("spec") == spec.name)
    root = f"{lake.root}/{lake.db(BRONZE)}/_claims/{spec.landing_table}"
    return claim_files(spark, root, offered.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")), done)


def land_files(spark: SparkSession, lake: Lake, spec: IngestSpec, typed: DataFrame, landing: str,
               mine: Claim, files: DataFrame, at: dt.datetime) -> tuple[int, int]:
    """Land the rows of ``files`` (path) under a claim, once whatever breaks.

    One pass over the source stages accepted and rejected rows together, apart from
    all other runs. From then on the run is to be published, by itself or by the next
    one that finds it dead: staged files are moved into the landing's months, rejects
    and manifest rows are appended under the run's name, and each of these steps can
    be repeated. Returns (accepted, rejected).
    """
    place = _place(spark, landing, mine.run)
    schema = spark.table(landing).schema
    obs = Observation(f"ingest_{mine.run[:8]}")
    # rows clustered by landing month: a few right-sized files per month instead of one
    # per input task and month; the counters sit after the exchange so a re-run map stage
    # cannot count rows twice
    (typed.hint("rebalance", LANDING_PART_COL)
     .observe(obs, F.count(F.lit(1)).alias("n"), F.count_if(F.col(REASON_COL) != "").alias("bad"))
     .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], REASON_COL,
             (F.col(REASON_COL) != "").alias(REJECTED_COL))
     .write.partitionBy(REJECTED_COL, LANDING_PART_COL).parquet(place))
    files.write.parquet(f"{place}-files")
    m = obs.get
    bad = int(m["bad"])
    publishing(spark, mine.root, mine.run, [str(int(m["n"]) - bad), str(bad), at.isoformat()])
    publish(spark, lake, spec, landing, mine, mine.run)
    return int(m["n"]) - bad, bad


def _place(spark: SparkSession, landing: str, run: str) -> str:
    return f"{table_location(spark, landing)}/_incoming/{run}"


def publish(spark: SparkSession, lake: Lake, spec: IngestSpec, landing: str, mine: Claim, run: str) -> None:
    """Move what ``run`` staged into the landing, the rejects and the manifest, as far as
    that has not been done, and close its claim."""
    n, bad, at = published_facts(spark, mine.root, run)
    place = _place(spark, landing, run)
    _move_accepted(spark, landing, place, run)
    if int(bad):
        _add_rejects(spark, lake, spec, place, run)
    _add_manifest(spark, lake, spec, place, run, int(n), int(bad), dt.datetime.fromisoformat(at))
    close_claim(spark, mine.root, run)
    delete_path(spark, place)
    delete_path(spark, f"{place}-files")


def _move_accepted(spark: SparkSession, landing: str, place: str, run: str) -> None:
    """One rename for each staged file, as a job's commit does; names hold the run."""
    root = table_location(spark, landing)
    for month in list_path(spark, f"{place}/{REJECTED_COL}=false"):
        name = month.rsplit("/", 1)[1]
        for f in list_path(spark, month):
            move_path(spark, f, f"{root}/{name}/{run}-{f.rsplit('/', 1)[1]}")
        day = name.partition("=")[2]
        value = "NULL" if day == "__HIVE_DEFAULT_PARTITION__" else f"DATE'{day}'"
        spark.sql(f"ALTER TABLE {landing} ADD IF NOT EXISTS PARTITION ({LANDING_PART_COL} = {value})")
    spark.catalog.refreshTable(landing)


def _add_rejects(spark: SparkSession, lake: Lake, spec: IngestSpec, place: str, run: str) -> None:
    rows = spark.read.option("basePath", place).parquet(f"{place}/{REJECTED_COL}=true")
    append_run(spark, lake.fq(BRONZE, REJECTS), rows.select(
        F.lit(spec.name).alias("spec"), SOURCE_FILE_COL, REASON_COL,
        F.to_json(F.struct(*[c for c in rows.columns if c not in (REASON_COL, SOURCE_FILE_COL, REJECTED_COL)])).alias("row")), run)


def _add_manifest(spark: SparkSession, lake: Lake, spec: IngestSpec, place: str, run: str, n: int, bad: int,
                  at: dt.datetime) -> None:
    files = spark.read.schema("path string").parquet(f"{place}-files")
    append_run(spark, _manifest(spark, lake), files.select(
        "path", F.lit(spec.name).alias("spec"), F.lit(n).cast("long").alias("batch_rows"),
        F.lit(bad).cast("long").alias("batch_rejected"), F.lit(at).cast("timestamp_ntz").alias("landed_at")), run)


def ingest(spark: SparkSession, lake: Lake, spec: IngestSpec, paths: list[str] | DataFrame,
           run_date: dt.date | None = None, now: dt.datetime | None = None) -> IngestResult:
    """Land new files of one source, given as paths or as a frame with a column ``path``.

    A file that has landed, or that another run is landing, is skipped, so feeding the
    same file twice appends its rows once (S10). The paths of new files come to the
    driver, which lists them for Spark's reader; their first lines, rows and rejects
    stay in tasks, and the files' rows are read once (``land_files``). Files of an
    earlier run that broke off after its rows were complete are finished first.
    """
    res = IngestResult(spec.name)
    if spec.control_col and spec.control_from == "column" and spec.control_col not in dict(
            (dst, src) for src, dst in spec.column_map):
        raise ValueError(f"{spec.name}: no file column feeds the control column {spec.control_col} (V10)")
    if spec.control_from == "run_date" and run_date is None:
        run_date = load_timestamp(now).date()
    landing = lake.ensure_landing_table(spec)
    offered = paths if isinstance(paths, DataFrame) else spark.createDataFrame(
        [(full_path(spark, p),) for p in paths], "path string")
    mine = claim(spark, lake, spec, offered)
    res.skipped = offered.select("path").distinct().count() - (mine.n_paths if mine else 0)
    if mine is None:
        return res
    try:
        for run in mine.takes:
            publish(spark, lake, spec, landing, mine, run)
        new = [r["path"] for r in mine.paths.collect()]
        scan = scan_workbook if spec.file_type == "excel" else scan_delimited
        raw, res.bad_files = scan(spark, new, spec, [s for s, _ in spec.column_map])
        if raw is None:
            close_claim(spark, mine.root, mine.run)
            return res
        loaded_at = load_timestamp(now)
        typed = convert(raw, spec, loaded_at, run_date)
        res.files = [p for p in new if p not in res.bad_files]
        files = mine.paths
        if res.bad_files:
            files = spark.createDataFrame([(p,) for p in res.files], "path string")
        res.accepted, res.rejected = land_files(spark, lake, spec, typed, landing, mine, files, loaded_at)
    finally:
        end_run(mine.run)
    return res


def seed_rows(spark: SparkSession, lake: Lake, spec: IngestSpec, rows: DataFrame,
              now: dt.datetime | None = None) -> int:
    """Literal rows straight into landing (S11), then the table's row count (A1)."""
    landing = lake.ensure_landing_table(spec)
    loaded_at = load_timestamp(now)
    df = rows
    if ID_COL not in df.columns:
        df = df.withColumn(ID_COL, F.expr("uuid()"))
    if LOAD_TS_COL not in df.columns:
        df = df.withColumn(LOAD_TS_COL, F.lit(loaded_at).cast("timestamp_ntz"))
    if SOURCE_FILE_COL not in df.columns:
        df = df.withColumn(SOURCE_FILE_COL, F.lit("seed"))
    if LANDING_PART_COL not in df.columns:
        base = F.col(spec.control_col) if spec.control_col and spec.control_col in df.columns \
            else F.col(LOAD_TS_COL)
        df = df.withColumn(LANDING_PART_COL, F.trunc(F.to_date(base), "month"))
    tgt = spark.table(landing).schema
    df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in tgt]) \
        .write.insertInto(landing, overwrite=False)
    return spark.table(landing).agg(F.count(F.lit(1))).first()[0]
