"""Tables that many runs append to at once: run log, manifest, rejects, quarantine.

Each append is written to a folder of its own outside the table and renamed into it
when it is complete, as the partition ``run=<id>``. Writers share no folder, so none
can remove another's unfinished files, and a reader never sees half an append.
``compact_runs`` merges the many small folders into one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.session import create_once, delete_path, list_path, move_path, path_exists, read_once

RUN_COL = "run"
INCOMING = "_incoming"
MERGED = "_merged"      # one file for each merge: the new run, then those that it replaces


def _location(spark: SparkSession, table: str) -> str:
    db, _, name = table.rpartition(".")
    if spark.catalog.tableExists(table):
        row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
        return row["data_type"].rstrip("/")
    return spark.catalog.getDatabase(db or "default").locationUri.rstrip("/") + "/" + name


def ensure_runs_table(spark: SparkSession, table: str, schema: T.StructType) -> str:
    """Create or re-attach a table of runs; returns its folder."""
    loc = _location(spark, table)
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        there = path_exists(spark, loc)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {RUN_COL} STRING) USING parquet "
                  f"PARTITIONED BY ({RUN_COL}) LOCATION '{loc}'")
        if there:
            _finish_merges(spark, loc)
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return loc


def append_run(spark: SparkSession, table: str, rows: DataFrame, run: str | None = None) -> str:
    """Append ``rows`` as one run; the table is created on first use."""
    run = run or uuid.uuid4().hex
    loc = ensure_runs_table(spark, table, rows.schema)
    place = f"{loc}/{INCOMING}/{run}"
    rows.write.parquet(place)
    move_path(spark, place, f"{loc}/{RUN_COL}={run}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({RUN_COL} = '{run}')")
    return run


def _runs(spark: SparkSession, loc: str) -> list[str]:
    names = (p.rsplit("/", 1)[1] for p in list_path(spark, loc))
    return sorted(n.removeprefix(f"{RUN_COL}=") for n in names if n.startswith(f"{RUN_COL}="))


def compact_runs(spark: SparkSession, table: str) -> int:
    """Merge the runs that are there now into one; returns how many there were.

    The merge is decided by one file that names the new run and those it replaces,
    created once the new run is written. Whatever breaks after it, the next call or
    session removes the replaced ones (``_finish_merges``) before it reads; whatever
    breaks before it, the new run is not in the table. Runs that are added meanwhile stay."""
    loc = _location(spark, table)
    _finish_merges(spark, loc, table)
    old = _runs(spark, loc)
    if len(old) < 2:
        return len(old)
    run = f"merged-{uuid.uuid4().hex}"
    (spark.table(table).where(F.col(RUN_COL).isin(old)).drop(RUN_COL).hint("rebalance")
     .write.parquet(f"{loc}/{INCOMING}/{run}"))
    create_once(spark, f"{loc}/{MERGED}/{run}", old)
    _finish_merges(spark, loc, table)
    return len(old)


def _finish_merges(spark: SparkSession, loc: str, table: str | None = None) -> None:
    for path in list_path(spark, f"{loc}/{MERGED}"):
        run, old = path.rsplit("/", 1)[1], read_once(spark, path)
        if old is None:
            continue
        for i in range(0, len(old) if table else 0, 500):
            specs = ", ".join(f"PARTITION ({RUN_COL} = '{r}')" for r in old[i:i + 500])
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
        for r in old:
            delete_path(spark, f"{loc}/{RUN_COL}={r}")
        if path_exists(spark, f"{loc}/{INCOMING}/{run}"):
            move_path(spark, f"{loc}/{INCOMING}/{run}", f"{loc}/{RUN_COL}={run}")
        if table:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({RUN_COL} = '{run}')")
        delete_path(spark, path)


def find_runs(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all runs, those of other sessions too."""
    if path_exists(spark, _location(spark, table)):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table).drop(RUN_COL)
