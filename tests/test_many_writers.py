"""Versions of windows, appends by many runs, claims of files, and files read in tasks."""
import datetime as dt
import os
import shutil
import subprocess
import sys
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from periodica.functions.periods import MONTHLY, window_for
from periodica.operators.ordered import accumulate, numbered_lines, running_total
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.session import create_once, list_path, read_once, unique_path
from periodica.sources import claims
from periodica.sources.appends import append_run, compact_runs, find_runs
from periodica.sources.files import first_lines, header_groups, list_files, scan_workbook, write_xlsx, xlsx_rows
from periodica.sources.ingest import ingest, landed_files
from periodica.sources.versions import (commit_numbers, commit_window, existing_partitions, forget_windows, partition_location,
                                        sync_windows, table_location)
from periodica.spec import IngestSpec

DAY = dt.date(1995, 3, 15)
START = window_for(DAY, MONTHLY).start
SPEC = IngestSpec(name="T", file_pattern=r"^T_.*\.csv$", landing="LMDA.T", column_map=(("CODE", "CODE"), ("DAY", "DAY")),
                  date_fields=("DAY",), text_fields=(("CODE", 6),), control_col="DAY",
                  final_columns=("ID", "CODE", "DAY", "FECHA_EXTRACCION"), file_type="csv")


def _files(spark, bodies) -> str:
    folder = unique_path(spark, "drop")
    os.makedirs(folder)
    for name, body in bodies.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            fh.write(body)
    return folder


def test_created_once(spark):
    path = unique_path(spark, "once")
    assert create_once(spark, path, ["a", "b"]) and not create_once(spark, path, ["c"])
    assert read_once(spark, path) == ["a", "b"]
    with open(path, "w") as fh:
        fh.write("a")               # a writer that died half-way
    assert read_once(spark, path) is None and read_once(spark, path + "x") is None


def _loaded(spark, lake):
    spec = td.orders_spec(MONTHLY)
    assert reports.load(spark, lake, spec, DAY, landing=td.orders_landing(spark, SF_SMALL)).ok
    table = lake.report_table(spec)
    return spec, table, table_location(spark, table), spark.table(table).count()


def test_a_commit_is_seen_by_another_session(spark, lake):
    spec, table, root, n = _loaded(spark, lake)
    folder = f"{root}/_versions/elsewhere"
    spark.table(table).drop("period_start").limit(2).write.parquet(folder)
    assert not commit_window(spark, root, START, 0, folder)         # version 1 is taken
    assert commit_window(spark, root, START, 1, folder)
    assert spark.table(table).count() == n and lake.report(spec).count() == 2
    assert commit_window(spark, root, START, 2, None)               # emptied
    assert lake.report(spec).count() == 0 and existing_partitions(spark, table) == set()
    with open(f"{root.replace('file:', '')}/_commits/{START}.00000004", "w") as fh:
        fh.write("_versions/els")                                   # torn: its writer died
    assert commit_numbers(spark, root)[START][-1] == 4 and lake.report(spec).count() == 0
    again = reports.load(spark, lake, spec, DAY, landing=td.orders_landing(spark, SF_SMALL))
    assert again.ok and lake.report(spec).count() == n and commit_numbers(spark, root)[START][-1] == 5


def test_a_load_starts_over_when_another_came_first(spark, lake):
    spec, table, root, n = _loaded(spark, lake)
    calls = []

    def rows():
        calls.append(1)
        if len(calls) == 1:         # another load of the window commits while this one computes
            assert commit_window(spark, root, START, sync_windows(spark, table, root)[START], None)
        return spark.table(table).drop("period_start").limit(0).unionByName(td_rows)
    stored = spark.table(table).drop("period_start")
    td_rows = spark.createDataFrame(stored.limit(3).collect(), stored.schema)
    from periodica.operators.window_sink import replace_window
    res = replace_window(spark, table, rows, window_for(DAY, MONTHLY), "job")
    assert res.ok and len(calls) == 2 and res.deleted == 0 and lake.report(spec).count() == 3


def test_a_new_session_reads_the_committed_folder(spark, lake):
    spec, table, root, n = _loaded(spark, lake)
    assert reports.load(spark, lake, spec, DAY, landing=td.orders_landing(spark, SF_SMALL)).ok
    live = partition_location(spark, table, START)
    spark.sql(f"DROP TABLE {table}")
    forget_windows(spark, table)
    lake.ensure_report_table(spec)
    assert partition_location(spark, table, START) == live and spark.table(table).count() == n


def test_appends_and_a_merge_that_broke_off(spark, lake, monkeypatch):
    from periodica.sources import appends
    table = lake.fq("silver", "notes")
    for i in range(4):
        append_run(spark, table, spark.createDataFrame([(i, "x")], "n int, s string"))
    finish = appends._finish_merges
    with monkeypatch.context() as m:
        m.setattr(appends, "_finish_merges", lambda *a: None)       # dies right after its decision
        compact_runs(spark, table)
    assert find_runs(spark, table).count() == 4
    finish(spark, appends._location(spark, table), table)
    assert sorted(r.n for r in find_runs(spark, table).collect()) == [0, 1, 2, 3]
    loc = appends._location(spark, table)
    assert len([p for p in list_path(spark, loc) if "/run=" in p]) == 1 and not list_path(spark, f"{loc}/_merged")
    spark.sql(f"DROP TABLE {table}")                                # another session
    append_run(spark, table, spark.createDataFrame([(9, "y")], "n int, s string"))
    assert sorted(r.n for r in find_runs(spark, table).collect()) == [0, 1, 2, 3, 9]


def test_claims_of_live_dead_and_foreign_runs(spark):
    root = unique_path(spark, "claims")
    none = spark.createDataFrame([], "path string")
    offered = spark.createDataFrame([(f"p{i}",) for i in range(4)], "path string")
    first = claims.claim_files(spark, root, offered.limit(3), lambda: none)
    assert first.n_paths == 3
    second = claims.claim_files(spark, root, offered, lambda: none)
    assert [r.path for r in second.paths.collect()] == ["p3"] and claims.claim_files(spark, root, offered, lambda: none) is None
    claims.end_run(first.run)                       # dead, with nothing to publish: its files are free
    third = claims.claim_files(spark, root, offered, lambda: none)
    assert third.n_paths == 3 and third.takes == []
    with pytest.raises(RuntimeError, match="given up"):
        claims.publishing(spark, root, first.run, [])
    claims.publishing(spark, root, third.run, ["3", "0"])
    claims.end_run(third.run)                       # dead, but its rows are complete: the next run publishes them
    fourth = claims.claim_files(spark, root, offered, lambda: none)
    assert fourth.takes == [third.run] and fourth.n_paths == 0
    for run in (third.run, second.run, fourth.run):
        claims.close_claim(spark, root, run)
    now = dt.datetime.now(dt.timezone.utc)
    for n, (run, at) in enumerate((("theirs", now), ("old", now - claims.LEASE)), 50):     # of another application
        spark.createDataFrame([(f"{run}-file",)], "path string").write.parquet(f"{root}/runs/{run}")
        create_once(spark, f"{root}/log/{n:08d}", [run, "app-elsewhere", at.isoformat()])
    mine = claims.claim_files(spark, root, spark.createDataFrame([("theirs-file",), ("old-file",)], "path string"), lambda: none)
    assert [r.path for r in mine.paths.collect()] == ["old-file"]


def test_ten_thousand_small_files(spark, lake):
    """Routed, grouped by header and landed without opening a file on the driver."""
    bodies = {f"T_{i}.csv": ("CODE|DAY\n" if i % 3 else "DAY|X|CODE\n") + ("c%d|2026-04-%02d\n" % (i % 999, 1 + i % 28) if i % 3
              else "2026-04-%02d|x|c%d\n" % (1 + i % 28, i % 999)) for i in range(10_000)}
    bodies["T_bad.csv"] = "CODE|OTHER\nc|1\n"
    bodies["T_none.csv"] = ""
    files = list_files(spark, _files(spark, bodies))
    from periodica.sources import files as module
    assert not hasattr(module, "read_header")
    res = ingest(spark, lake, SPEC, files.select("path"), now=dt.datetime(2026, 4, 20))
    assert (res.accepted, res.rejected, len(res.bad_files)) == (10_000, 0, 1)      # files of no bytes are not listed
    land = spark.table(lake.fq("bronze", SPEC.landing_table))
    assert land.where("CODE LIKE 'c%'").count() == 10_000 and land.select("source_file").distinct().count() == 10_000
    assert landed_files(spark, lake).count() == 10_000


def test_first_lines(spark):
    folder = _files(spark, {"a.csv": "﻿A|B\n1|2\n", "b.csv": "\nA|B\n", "c.csv": "A|B", "d e.csv": "Ñ|B\n", "n.csv": ""})
    groups = header_groups(first_lines(spark, sorted(os.path.join(folder, f) for f in os.listdir(folder))))
    assert {h: sorted(p.rsplit("/", 1)[1] for p in g) for h, g in groups.items()} == {"A|B": ["a.csv", "b.csv", "c.csv"], "Ñ|B": ["d e.csv"]}


def test_workbook_rows_one_by_one(spark):
    data = write_xlsx([["A", "B"], *[[f"text {i}", i] for i in range(30_000)]])
    tracemalloc.start()
    assert next(xlsx_rows(data)) == ["A", "B"]
    few = tracemalloc.get_traced_memory()[1]
    n = sum(1 for _ in xlsx_rows(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 30_001 and peak < few + 2_000_000
    folder = unique_path(spark, "drop")
    os.makedirs(folder)
    for i, head in enumerate((["A", "B"], ["B", None, "A"], ["A"])):
        with open(f"{folder}/w{i}.xlsx", "wb") as fh:
            fh.write(write_xlsx([head, [f"v{j}" for j in range(len(head))], []]))
    df, bad = scan_workbook(spark, sorted(f"{folder}/w{i}.xlsx" for i in range(3)), required=["A", "B"])
    assert sorted((r.A or "", r.B or "") for r in df.collect()) == [("", ""), ("", ""), ("v0", "v1"), ("v2", "v0")]
    assert list(bad.values()) == [["B"]]


def test_workbooks_are_bounded(spark):
    """A workbook holds a bounded number of rows however many its task has; nulls and marks survive."""
    from periodica.plans.ingest_queries import write_workbooks
    folder = unique_path(spark, "drop")
    rows = [(f"k{i}", None if i % 3 else f"<{i}> & é") for i in range(1000)]
    write_workbooks(spark.createDataFrame(rows, "a string, b string").repartition(3), folder, "W", 100)
    books = [r.path for r in list_files(spark, folder).collect()]
    assert len(books) >= 10
    heads, found = set(), []
    for p in books:
        with open(p.removeprefix("file:"), "rb") as fh:
            head, *body = xlsx_rows(fh.read())
        assert len(body) <= 100
        heads.add(tuple(head))
        found += [tuple(dict(zip(head, r)).get(c) for c in "ab") for r in body]
    assert heads == {("a", "b"), ("b", "a")} and sorted(found) == sorted(rows)
    none = unique_path(spark, "drop")
    write_workbooks(spark.createDataFrame([], "a string, b string").repartition(2), none, "W", 100)
    for r in list_files(spark, none).collect():
        with open(r.path.removeprefix("file:"), "rb") as fh:
            assert [sorted(x) for x in xlsx_rows(fh.read())] == [["a", "b"]]


def test_sheet_cells():
    """Gaps, several text runs, shared strings, booleans, cells without a reference, over many blocks."""
    import io
    import zipfile
    data = io.BytesIO(write_xlsx([]))
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    row = ('<row r="{0}">\n<c r="A{0}" t="s"><v>1</v></c> <c r="C{0}" t="inlineStr"><is><r><t>x</t></r><r><t> y</t></r></is></c>'
           '<c t="b"><v>1</v></c><c r="AA{0}"><f>1+1</f><v>2</v></c><c r="AB{0}" t="inlineStr"><is><t></t></is></c><c r="AC{0}"><v></v></c></row>\n')
    out = io.BytesIO()
    with zipfile.ZipFile(data) as old, zipfile.ZipFile(out, "w") as z:
        for n in old.namelist():
            z.writestr(n, old.read(n) if "sheet1" not in n else
                       f'<worksheet xmlns="{ns}"><cols/>\n<sheetData>{"".join(row.format(i) for i in range(1, 3001))}<row/></sheetData><x/></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>a</t></si><si><r><t>b</t></r><r><t>é</t></r></si></sst>')
    *rows, last = xlsx_rows(out.getvalue())
    assert last == [] and len(rows) == 3000
    assert all(r == ["bé", None, "x y", "TRUE", *[None] * 22, "2", "", None] for r in rows)


def test_order_over_partitions(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.lit(None).cast("string")).alias("g"),
                                    F.format_string("%05d", "id").alias("v"))
    lines = numbered_lines(rows, [F.col("v").desc()]).collect()
    assert [r.v for r in sorted(lines, key=lambda r: r.line)] == [f"{i:05d}" for i in reversed(range(3000))]
    out = running_total(rows, ["g"], [F.col("v")], F.lit(2), "before").collect()
    assert sorted(r.before for r in out if r.g) == [2 * i for i in range(2000)]
    text = {}
    for r in sorted(accumulate(rows, ["g"], "v", 100).collect(), key=lambda r: (r.g or "", r.line_no)):
        assert len(r.text) <= 105
        text.setdefault(r.g, []).append(r.text)
    assert ", ".join(text["hot"]) == ", ".join(f"{i:05d}" for i in range(3000) if i % 3)
    assert ", ".join(text[None]) == ", ".join(f"{i:05d}" for i in range(0, 3000, 3))


def test_more_rows_in_order_make_more_tasks_not_larger_ones(spark, monkeypatch):
    monkeypatch.setattr("periodica.operators.ordered.TASK_ROWS", 100, raising=False)
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = spark.range(5000).select(F.col("id").alias("v"), F.when(F.col("id") % 5 > 0, 1).alias("g"))
        lines = numbered_lines(rows, [F.col("v").desc()]).select("*", F.spark_partition_id().alias("task")).collect()
        by_group = running_total(rows, ["g"], [F.col("v")], F.lit(1), "before").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
    assert all(r.line == 5000 - r.v for r in lines) and len(lines) == 5000
    assert sorted(r.before for r in by_group if r.g) == list(range(4000))
    assert sorted(r.before for r in by_group if r.g is None) == list(range(1000))
    assert max(Counter(r.task for r in lines).values()) < 1500


def test_the_entry_lives_without_training_data(tmp_path):
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(here, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q); print(len(q), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    n, sql = map(int, out.stdout.split())
    assert n == sql and n > 120
