"""Registered queries of the 15 ingestion configs (I021 .. I210): files in each
source's own form, made by Spark from a whole test table, are routed, read by header,
converted and landed.

Workbooks (S3) of bounded size are written by tasks, row by row. Values follow the rule of
``report_queries.source_expr``, as text in the files and as typed values in the
oracle; every second workbook has its columns the other way round, so that reading by
position would show.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.layouts import INGEST, SPECS
from periodica.plans import testdata as td
from periodica.plans.registry import register, scratch_lake
from periodica.plans.report_queries import stored_expr
from periodica.session import unique_path
from periodica.sources.files import SHEET_ROWS, list_files, route, text_row, text_rows, write_sheet
from periodica.sources.ingest import ingest
from periodica.spec import ID_COL, LANDING_PART_COL, LOAD_TS_COL, SOURCE_FILE_COL, IngestSpec, ReportSpec

SRC, RUN_DATE = "events", dt.date(2024, 2, 1)
WORKBOOKS = 8       # files that a source is dealt into, at least
BOOK_ROWS = 50_000  # of a workbook, at most


def file_stem(spec: IngestSpec) -> str:
    """What a file's name begins with, before the wildcard or the extension of its pattern."""
    return re.split(r"\.\*|\\\.", spec.file_pattern.lstrip("^"))[0]


def _stored(spec: ReportSpec, ing: IngestSpec, landing: str):
    back = {land: stored for land, stored in spec.load_renames}
    name = back.get(landing, landing)
    return next(c for c in spec.stored_columns if c.name == name)


def file_columns(spec: ReportSpec, ing: IngestSpec) -> list:
    """The cells of a file as text, under the file's headers."""
    out = []
    for header, landing in ing.column_map:
        c = _stored(spec, ing, landing)
        e = F.expr(stored_expr(spec, c.name, SRC))
        e = F.date_format(e, "yyyy/MM/dd") if c.type.kind == "date" else e.cast("string")
        out.append(e.alias(header))
    return out


def write_workbooks(df: DataFrame, folder: str, stem: str, most: int = BOOK_ROWS) -> None:
    """Workbooks of at most ``most`` rows, each in a folder of its own, since a source may have
    one name only. A task writes its partition's rows as they come, one workbook after
    the other; every second one has its columns the other way round."""
    headers = df.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        place, path = ((fs.LocalFileSystem(), folder.removeprefix("file:")) if folder.startswith(("/", "file:"))
                       else fs.FileSystem.from_uri(folder))
        left = next(batches, None)

        def sheet(turned: bool) -> Iterator[bytes]:
            """The next rows, and in ``left`` what comes after them."""
            nonlocal left, n
            names, at = headers[::-1] if turned else headers, 2
            yield text_row(names, 1)
            while left is not None and at < most + 2:
                some = min(SHEET_ROWS, most + 2 - at)
                rows, left = left.slice(0, some), left.slice(some)
                yield text_rows(rows.select(names), at)
                at, n = at + rows.num_rows, n + rows.num_rows
                while left is not None and not left.num_rows:
                    left = next(batches, None)

        for k in count():
            if k and left is None:
                break
            book = posixpath.join(path, f"{part}-{k}")
            place.create_dir(book, recursive=True)
            with place.open_output_stream(posixpath.join(book, f"{stem}.xlsx")) as out:
                write_sheet(out, sheet((part + k) % 2 == 0))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])
    df.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def landed_sql(spec: ReportSpec, ing: IngestSpec) -> str:
    out = []
    for f in ing.landing_schema():
        if f.name in (ID_COL, LOAD_TS_COL):
            continue
        if f.name == ing.control_col and ing.control_from == "run_date":
            out.append(f"DATE '{RUN_DATE}' AS {f.name}")
            continue
        e = stored_expr(spec, _stored(spec, ing, f.name).name, SRC)
        kind = f.dataType.simpleString()
        cast = {"date": "DATE", "string": "VARCHAR"}.get(kind, kind.upper())
        out.append(f"CAST({e} AS {cast}) AS {f.name}")
    return f"SELECT {', '.join(out)} FROM {SRC}"


def _register(numero: int) -> None:
    spec, ing = SPECS[numero], INGEST[numero]

    @register(f"ingest_{numero:03d}", landed_sql(spec, ing))
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, folder = scratch_lake(spark), unique_path(spark, "drop")
        rows = td.table(spark, sf_dir, SRC)
        if ing.file_type == "excel":
            # more rows make more workbooks, not larger ones; the table's own columns are dealt out, not the cells
            rows = rows.repartition(max(WORKBOOKS, 2 * rows.count() // BOOK_ROWS))
        cells = rows.select(*file_columns(spec, ing))
        if ing.file_type == "excel":
            write_workbooks(cells, folder, file_stem(ing))
        else:
            plain = unique_path(spark, "drop")
            cells.write.option("header", True).option("sep", ing.delimiter).option("quote", "\u0000").csv(plain)
            _rename_parts(spark, plain, folder, file_stem(ing))
        files = route(list_files(spark, folder), INGEST.values()).where((F.col("spec") == ing.name) & (F.col("n_matches") == 1))
        res = ingest(spark, lake, ing, files, run_date=RUN_DATE, now=dt.datetime(2024, 2, 1, 8, 0, 31))
        if res.rejected or res.bad_files:
            raise RuntimeError(f"{res.rejected} rejected rows, {res.bad_files}")
        land = spark.table(lake.fq("bronze", ing.landing_table))
        return land.drop(ID_COL, LOAD_TS_COL, SOURCE_FILE_COL, LANDING_PART_COL)
    q.__doc__ = f"I{numero:03d}: {ing.name}, {ing.file_type} files named {ing.file_pattern}, into {ing.landing}."


def _rename_parts(spark: SparkSession, plain: str, folder: str, stem: str) -> None:
    from periodica.session import list_path, move_path
    for i, p in enumerate(x for x in list_path(spark, plain) if x.endswith(".csv")):
        move_path(spark, p, f"{folder}/{stem}_{i}.csv")


for _n in sorted(INGEST):
    _register(_n)
