"""Spark session settings and the shared folder used for staging and scratch tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job of the engine relies on. Time zone UTC keeps date casts of
# timestamp_ntz inputs stable; ANSI mode turns over-length / overflow inserts
# into errors (the quality checks run before any write so those never fire);
# static partition overwrite is what makes window replacement exact.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rebalanced writes (multi-window backfills, landing appends) aim at
    # ~16 MB per task/file; AQE splits a window or month holding a third of
    # all rows into several tasks and packs small ones together. These are bytes
    # as shuffled, compressed; a task sorts its rows as they are, ten times as large or more
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    # the JVM interprets a method of more bytes of code: the wide conversions of a landing
    # run several times faster as smaller methods than as one of a whole stage
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a batch for Python ends with the row that takes it over this: one workbook or a few
    # thousand wide rows, not 64 MB of them; a worker and its task hold several copies of it
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # paths given one by one are listed by a job of this many tasks at most
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # a checkpoint goes with the last reference to it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# a text file next to a table's folder: its folder since the last migration, and the one before
LOCATION_SUFFIX = ".location"
END_LINE = "."      # last line of a file of ``create_once``


def build_session(master: str | None = None, app: str = "periodica",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[*]``. Nothing here overrides a value the cluster already set for
    ``spark.checkpoint.dir``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    ensure_shared_dir(spark)
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's value is always used when present. Only when it is unset and
    the master is local (tests) a fresh folder under the temp dir is created and
    set; on a cluster an unset folder is an error, as executors share no other.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="periodica-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (works for file:, hdfs:, s3a: roots)."""
    root = ensure_shared_dir(spark).rstrip("/")
    return "/".join([root, *parts])


def unique_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused path under the shared folder (staging, scratch)."""
    return shared_path(spark, "periodica", kind, uuid.uuid4().hex)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark's file metadata gives it."""
    if ":/" in path:
        return path
    p, fs = _file(spark, path)
    return str(fs.makeQualified(p).toString())


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Replace a small text file (Hadoop FS, any scheme)."""
    p, fs = _file(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small text file; none where it does not exist."""
    local = _on_local_disk(spark, path)
    if local:
        try:
            with open(local, encoding="utf-8") as f:
                return f.read().splitlines()
        except FileNotFoundError:
            return []
    p, fs = _file(spark, path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        out = []
        while (line := reader.readLine()) is not None:
            out.append(line)
        return out
    finally:
        reader.close()


_default_is_local: dict[str, bool] = {}


def _on_local_disk(spark: SparkSession, path: str) -> str | None:
    """The path as this process opens it, where it lies on the local file system."""
    if path.startswith("file:"):
        return re.sub("^file:/+", "/", path)
    if not path.startswith("/"):
        return None
    app = spark.sparkContext.applicationId
    if app not in _default_is_local:
        _, fs = _file(spark, path)
        _default_is_local[app] = str(fs.getUri().getScheme()) == "file"
    return path if _default_is_local[app] else None


def create_once(spark: SparkSession, path: str, lines: list[str]) -> bool:
    """Create a small text file, or return False where it exists: of several that
    try, one succeeds. The file ends with a line of its own, so that one whose
    writer died is told from a whole one (``read_once``)."""
    body = "\n".join([*lines, END_LINE]).encode()
    local = _on_local_disk(spark, path)
    if local:       # Hadoop's local file system looks and then creates, in two steps
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            fd = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(fd, "wb") as f:
            f.write(body)
        return True
    p, fs = _file(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception.getClass().getName()) or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(body))
    finally:
        out.close()
    return True


def read_once(spark: SparkSession, path: str) -> list[str] | None:
    """Lines of a file of ``create_once``; None where it is missing or not whole."""
    lines = read_lines(spark, path)
    return lines[:-1] if lines and lines[-1] == END_LINE else None


def move_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder that is complete into its place, in one step."""
    p, fs = _file(spark, old)
    q, _ = _file(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise RuntimeError(f"{old} could not be renamed to {new}")


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Paths directly under a folder; none where it does not exist."""
    local = _on_local_disk(spark, path)
    if local:       # without a call of the JVM for each path; checksum files are not shown there either
        names = os.listdir(local) if os.path.isdir(local) else []
        return [f"file:{local.rstrip('/')}/{n}" for n in names if not (n.startswith(".") and n.endswith(".crc"))]
    p, fs = _file(spark, path)
    return [str(s.getPath().toString()) for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staging folder the engine itself created (Hadoop FS, any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def local_test_session() -> SparkSession:
    """Session used by tests and the local bench: local[*], 8 shuffle partitions."""
    cpus = os.environ.get("BENCH_CPUS", "*")
    return build_session(master=f"local[{cpus}]", shuffle_partitions=8,
                         extra={"spark.driver.memory": "8g"})
