"""Which run lands which files (S10), with any number of runs at once.

A run offers paths. Those that the manifest does not hold and no other run is
landing become its claim: a table of paths in ``runs/<run>``, and one file
``log/<number>`` that is created once. A run that finds its number taken lost to
another claim, reads the log again and takes what is left, so no path is claimed
twice. Paths are joined on Spark; the driver reads one small file for each run
that is still open.

What a run has staged is decided by ``fate/<run>``, also created once: the run
itself writes ``publish`` when its rows are complete, and a later run writes
``void`` when it finds the first one dead. Whoever comes first is right: a void run
must not publish, and the files of a run to be published are published by the one
that found it, from what it staged. A run of the same application is dead as soon
as it has ended, one of another application when its lease is over.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from periodica.session import create_once, delete_path, list_path, read_once

LEASE = dt.timedelta(hours=12)      # of a run of another application
TRIES = 20
PUBLISH, VOID = "publish", "void"

_active: set[str] = set()           # runs of this process that have not ended


@dataclass(frozen=True)
class Entry:
    number: int
    run: str
    application: str
    begun: dt.datetime
    takes: tuple[str, ...]          # dead runs that this one finishes

    def alive(self, application: str, now: dt.datetime) -> bool:
        return self.run in _active if self.application == application else now - self.begun < LEASE


@dataclass
class Claim:
    root: str
    run: str
    paths: DataFrame                # path: the files that this run lands
    n_paths: int
    takes: list[str] = field(default_factory=list)


def _names(spark: SparkSession, folder: str) -> list[str]:
    return sorted(p.rsplit("/", 1)[1] for p in list_path(spark, folder))


def _log(spark: SparkSession, root: str) -> tuple[int, list[Entry]]:
    """The last number of the log, and its open entries."""
    numbers, closed = [int(n) for n in _names(spark, f"{root}/log") if n.isdigit()], set(_names(spark, f"{root}/closed"))
    entries = []
    for n in numbers:
        lines = read_once(spark, f"{root}/log/{n:08d}")
        if lines and lines[0] not in closed:
            entries.append(Entry(n, lines[0], lines[1], dt.datetime.fromisoformat(lines[2]), tuple(lines[3:])))
    return max(numbers, default=0), entries


def _paths(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], "path string")
    return spark.read.schema("path string").parquet(*[f"{root}/runs/{r}" for r in runs])


def claim_files(spark: SparkSession, root: str, offered: DataFrame, done: Callable[[], DataFrame]) -> Claim | None:
    """Claim those of the ``offered`` paths (path) that are not ``done`` and not claimed;
    None where there are none and no dead run is to be finished."""
    run, app = uuid.uuid4().hex, spark.sparkContext.applicationId
    _active.add(run)
    try:
        for _ in range(TRIES):
            last, entries = _log(spark, root)
            now = dt.datetime.now(dt.timezone.utc)
            live = [e for e in entries if e.alive(app, now)]
            taken = {r for e in live for r in e.takes}
            dead = [e.run for e in entries if e not in live and e.run not in taken]
            takes = [r for r in dead if not create_once(spark, f"{root}/fate/{r}", [VOID]) and fate(spark, root, r) == PUBLISH]
            busy = _paths(spark, root, [e.run for e in live] + sorted(taken) + takes)
            place = f"{root}/runs/{run}"
            try:
                (offered.select("path").distinct().join(done().select("path"), "path", "left_anti")
                 .join(busy, "path", "left_anti").write.mode("overwrite").parquet(place))
            except Exception:
                if _log(spark, root)[0] == last:        # else another run has moved on and cleaned up
                    raise
                continue
            mine = _paths(spark, root, [run])
            n = mine.count()
            if not n and not takes:
                break
            if create_once(spark, f"{root}/log/{last + 1:08d}", [run, app, now.isoformat(), *takes]):
                for r in dead:
                    if r not in takes:
                        close_claim(spark, root, r)
                _clean(spark, root, last)
                return Claim(root, run, mine, n, takes)
        else:
            raise RuntimeError(f"{TRIES} other runs claimed files in {root} first")
    except BaseException:
        end_run(run)
        raise
    end_run(run)
    delete_path(spark, f"{root}/runs/{run}")
    return None


def fate(spark: SparkSession, root: str, run: str) -> str | None:
    lines = read_once(spark, f"{root}/fate/{run}")
    return lines[0] if lines else None


def publishing(spark: SparkSession, root: str, run: str, facts: list[str]) -> None:
    """Decide that ``run`` publishes; an error where another run has declared it void."""
    if not create_once(spark, f"{root}/fate/{run}", [PUBLISH, *facts]):
        raise RuntimeError(f"run {run} was given up by another run")


def published_facts(spark: SparkSession, root: str, run: str) -> list[str]:
    return read_once(spark, f"{root}/fate/{run}")[1:]


def close_claim(spark: SparkSession, root: str, run: str) -> None:
    create_once(spark, f"{root}/closed/{run}", [])


def end_run(run: str) -> None:
    """The run has ended, whether it is closed or not."""
    _active.discard(run)


def _clean(spark: SparkSession, root: str, upto: int) -> None:
    """Remove what closed runs have left in the log, up to a number. The fate of a void
    run stays, in case it is not dead after all."""
    closed = set(_names(spark, f"{root}/closed"))
    for name in _names(spark, f"{root}/log"):
        lines = read_once(spark, f"{root}/log/{name}") if int(name) <= upto else None
        if lines and lines[0] in closed:
            delete_path(spark, f"{root}/runs/{lines[0]}")
            delete_path(spark, f"{root}/log/{name}")
            if fate(spark, root, lines[0]) == PUBLISH:
                delete_path(spark, f"{root}/fate/{lines[0]}")
            delete_path(spark, f"{root}/closed/{lines[0]}")
