"""Versions of windows: which folder holds the rows of each window of a report table.

A load writes a window's rows into a folder of their own and then commits it: a
small file ``_commits/<period start>.<number>`` in the table's folder, created
once and never changed, names that folder. The highest number of a window is its
live version, so a window is replaced by the creation of one file. Whatever breaks
before leaves the old version live; of two loads that saw the same version, one
commits and the other is told so.

The catalog's partition locations follow the commits, for every kind of catalog:
``sync_windows`` repoints those that another session, or a run that broke off after
its commit, left behind. A window without commits is the partition's own folder.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from periodica.session import create_once, delete_path, list_path, read_once
from periodica.spec import PERIOD_COL

COMMITS, VERSIONS = "_commits", "_versions"
EMPTY = "-"         # the folder of a window that has been emptied


@dataclass(frozen=True)
class Version:
    number: int         # 0: no commit yet
    folder: str | None  # None: without rows


def same_folder(a: str, b: str) -> bool:
    """Whether two spellings name one folder (``file:/x`` and ``file:///x``)."""
    return re.sub(":/+", ":/", a.rstrip("/")) == re.sub(":/+", ":/", b.rstrip("/"))


def table_location(spark: SparkSession, table: str) -> str:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return row["data_type"].rstrip("/")


def partition_location(spark: SparkSession, table: str, start: dt.date) -> str | None:
    """Current folder of one window in the catalog, or None when the partition does not exist."""
    try:
        row = (spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({PERIOD_COL} = DATE'{start.isoformat()}')")
               .where("col_name = 'Location'").first())
    except AnalysisException as e:
        if "PARTITION" in (e.getCondition() or ""):      # no such partition; other errors are the run's
            return None
        raise
    return row["data_type"].rstrip("/") if row else None


def existing_partitions(spark: SparkSession, table: str) -> set[dt.date]:
    """Windows the table holds, from the catalog (one call)."""
    out = set()
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        for part in r[0].split("/"):
            k, _, v = part.partition("=")
            if k == PERIOD_COL and v and v != "__HIVE_DEFAULT_PARTITION__":
                out.add(dt.date.fromisoformat(v))
    return out


def _commit_path(root: str, start: dt.date, number: int) -> str:
    return f"{root}/{COMMITS}/{start.isoformat()}.{number:08d}"


def commit_numbers(spark: SparkSession, root: str) -> dict[dt.date, list[int]]:
    """The commits of each window, ascending, from one listing."""
    out: dict[dt.date, list[int]] = {}
    for path in sorted(list_path(spark, f"{root}/{COMMITS}")):
        day, _, number = path.rsplit("/", 1)[1].partition(".")
        if number.isdigit():
            out.setdefault(dt.date.fromisoformat(day), []).append(int(number))
    return out


def _read(spark: SparkSession, root: str, start: dt.date, numbers: list[int]) -> Version | None:
    """The last whole commit, under the last number; None where no writer finished one."""
    for number in reversed(numbers):
        lines = read_once(spark, _commit_path(root, start, number))
        if lines:
            return Version(numbers[-1], None if lines[0] == EMPTY else f"{root}/{lines[0]}")
    return None


def commit_window(spark: SparkSession, root: str, start: dt.date, seen: int, folder: str | None) -> bool:
    """Make ``folder`` (below ``root``) the version after number ``seen``; False where
    another run has committed since."""
    name = EMPTY if folder is None else folder.removeprefix(root + "/")
    if not create_once(spark, _commit_path(root, start, seen + 1), [name]):
        return False
    _remove_older(spark, root, start, seen)
    return True


def _remove_older(spark: SparkSession, root: str, start: dt.date, keep: int) -> None:
    """Remove what no reader needs: versions before the last but one, ``keep``. That one
    stays for readers that are still open."""
    if keep == 1:
        delete_path(spark, f"{root}/{PERIOD_COL}={start.isoformat()}")
    for number in range(keep - 1, max(keep - 4, 0), -1):
        path = _commit_path(root, start, number)
        lines = read_once(spark, path)
        if lines is not None:
            if lines[0] != EMPTY:
                delete_path(spark, f"{root}/{lines[0]}")
            delete_path(spark, path)


def point_partition(spark: SparkSession, table: str, start: dt.date, folder: str) -> None:
    """Make ``folder`` the partition's location with one catalog call."""
    spec = f"{PERIOD_COL} = DATE'{start.isoformat()}'"
    now = partition_location(spark, table, start)
    if now is None:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
    elif not same_folder(now, folder):
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")


# (application, table) -> windows and the number of the commit that the catalog shows
_shown: dict[tuple[str, str], dict[dt.date, int]] = {}


def shown_windows(spark: SparkSession, table: str) -> dict[dt.date, int]:
    return _shown.setdefault((spark.sparkContext.applicationId, table), {})


def point_windows(spark: SparkSession, table: str, versions: dict[dt.date, Version]) -> None:
    """Let the catalog show these versions. New windows take one call for 500 of them."""
    shown, held = shown_windows(spark, table), existing_partitions(spark, table) if len(versions) > 8 else None
    fresh = [s for s, v in sorted(versions.items()) if held is not None and v.folder and s not in held]
    for i in range(0, len(fresh), 500):
        specs = " ".join(f"PARTITION ({PERIOD_COL} = DATE'{s.isoformat()}') LOCATION '{versions[s].folder}'" for s in fresh[i:i + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    for start, v in versions.items():
        if v.folder is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PERIOD_COL} = DATE'{start.isoformat()}')")
        elif held is None or start in held:
            point_partition(spark, table, start, v.folder)
    if versions:
        spark.sql(f"REFRESH TABLE {table}")
    shown.update({s: v.number for s, v in versions.items()})


def sync_windows(spark: SparkSession, table: str, root: str) -> dict[dt.date, int]:
    """Let the catalog follow the commits; returns the number of each window's last one.
    One listing, and one small read for each window that has changed."""
    numbers = commit_numbers(spark, root)
    shown = shown_windows(spark, table)
    late = {s: _read(spark, root, s, n) for s, n in numbers.items() if shown.get(s) != n[-1]}
    point_windows(spark, table, {s: v for s, v in late.items() if v})
    return {s: n[-1] for s, n in numbers.items()}


def forget_windows(spark: SparkSession, table: str) -> None:
    """The catalog's table is another one now (dropped, migrated)."""
    _shown.pop((spark.sparkContext.applicationId, table), None)
