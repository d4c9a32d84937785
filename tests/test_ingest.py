"""Routing, reading by header name, typed conversion and rejects."""
import datetime as dt
import os

from pyspark.sql import functions as F

from periodica.layouts import INGEST
from periodica.session import unique_path
from periodica.sources.files import list_files, route, scan_workbook, write_xlsx, xlsx_rows
from periodica.sources.ingest import ingest, seed_rows
from periodica.spec import IngestSpec

SPEC = IngestSpec(
    name="T", file_pattern=r"^T_.*\.csv$", landing="LMDA.T",
    column_map=(("CODE", "CODE"), ("Amount", "AMOUNT"), ("DAY", "DAY")),
    date_fields=("DAY",), numeric_fields=(("AMOUNT", "numeric(5,2)"),),
    text_fields=(("CODE", 6),), allow_empty=True,
    final_columns=("ID", "CODE", "AMOUNT", "DAY", "FECHA_EXTRACCION"), file_type="csv")


def _folder(spark, files: dict[str, str]) -> str:
    folder = unique_path(spark, "drop")
    os.makedirs(folder, exist_ok=True)
    for name, body in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            fh.write(body)
    return folder


def test_route_exactly_one(spark):
    folder = _folder(spark, {"FILE_SWAP.xlsx": "x", "FILE_SWAP_FLUJO_1.xlsx": "x",
                             "FT_TENENCIA_1.csv": "x", "OTHER.txt": "x"})
    got = {r["name"]: (r["spec"], r["n_matches"])
           for r in route(list_files(spark, folder), INGEST.values()).collect()}
    assert got["FILE_SWAP.xlsx"] == ("SWAP", 1)          # anchored: not FILE_SWAP_CONVO
    assert got["FILE_SWAP_FLUJO_1.xlsx"] == ("SWAP_FLUJO", 1)
    assert got["FT_TENENCIA_1.csv"] == ("FT_TENENCIA", 1)
    assert got["OTHER.txt"] == (None, 0)


def test_header_by_name_types_and_rejects(spark, lake):
    folder = _folder(spark, {
        # different column order and an extra column in the second file
        "T_1.csv": "CODE|Amount|DAY\n000111|1.005|2026-04-17\n000112||17/04/2026\n",
        "T_2.csv": "DAY|EXTRA|CODE|Amount\n2026/04/18|z|0001234|12.5\n2026/13/01|z|000114|x\n",
        "T_3.csv": "CODE|DAY\n000115|2026-04-19\n",   # Amount header missing -> file rejected
    })
    paths = sorted(os.path.join(folder, f) for f in os.listdir(folder))
    res = ingest(spark, lake, SPEC, paths, now=dt.datetime(2026, 4, 20, 8, 0, 31))
    assert res.accepted == 2 and res.rejected == 2
    assert list(res.bad_files.values()) == [["Amount"]]
    land = spark.table(lake.fq("bronze", SPEC.landing_table))
    rows = {r["CODE"]: r for r in land.collect()}
    assert str(rows["000111"]["AMOUNT"]) == "1.01"              # half up, zero-led code kept as text
    assert rows["000112"]["AMOUNT"] is None                     # empty cell -> NULL (allow_empty)
    assert rows["000112"]["DAY"] == dt.date(2026, 4, 17)
    assert rows["000111"]["FECHA_EXTRACCION"] == dt.datetime(2026, 4, 20, 8, 1)
    rej = {r["_reason"] for r in spark.table(lake.fq("bronze", "rejects")).collect()}
    assert rej == {"CODE:varchar(6)", "AMOUNT:numeric(5,2);DAY:date"}


def test_allow_empty_false(spark, lake):
    import dataclasses
    spec = dataclasses.replace(SPEC, allow_empty=False)
    folder = _folder(spark, {"T_9.csv": "CODE|Amount|DAY\n000111||2026-04-17\n000112|1|2026-04-17\n"})
    res = ingest(spark, lake, spec, [os.path.join(folder, "T_9.csv")])
    assert (res.accepted, res.rejected) == (1, 1)


def test_workbook_first_sheet(spark):
    data = write_xlsx([["CODE", "Amount", "DAY"], ["000111", "1.5", "2026-04-17"], ["000112", None, "x"]])
    assert list(xlsx_rows(data))[1] == ["000111", "1.5", "2026-04-17"]
    folder = unique_path(spark, "drop")
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, "T_1.xlsx")
    with open(p, "wb") as fh:
        fh.write(data)
    df, bad = scan_workbook(spark, [p, os.path.join(folder, "T_2.xls")], required=["CODE"])
    assert list(bad.values()) == [["legacy .xls is not read"]]
    got = sorted((r["CODE"], r["Amount"]) for r in df.collect())
    assert got == [("000111", "1.5"), ("000112", None)]


def test_seed_and_count(spark, lake):
    rows = spark.createDataFrame([("000111", "1.5", dt.date(2026, 1, 1))] * 3, "CODE string, AMOUNT string, DAY date")
    assert seed_rows(spark, lake, SPEC, rows.withColumn("AMOUNT", F.col("AMOUNT").cast("decimal(5,2)"))) == 3


def test_stream_restart_lands_each_file_once(spark, lake):
    """The landing stream resumes from its checkpoint: a second run over the
    same folder adds nothing; a new file adds only its rows."""
    from periodica.streaming.landing_stream import land_stream
    folder = _folder(spark, {"T_1.csv": "CODE|Amount|DAY\n000111|1.5|2026-04-17\n000112|2|17/04/2026\n"})
    ckpt = unique_path(spark, "stream-ckpt")
    land_stream(spark, lake, SPEC, folder, checkpoint=ckpt)
    land_stream(spark, lake, SPEC, folder, checkpoint=ckpt)
    t = lake.fq("bronze", SPEC.landing_table)
    assert spark.table(t).count() == 2
    with open(os.path.join(folder, "T_2.csv"), "w", encoding="utf-8") as fh:
        fh.write("CODE|Amount|DAY\n000113|3|2026/04/18\n")
    land_stream(spark, lake, SPEC, folder, checkpoint=ckpt)
    assert sorted(r[0] for r in spark.table(t).select("CODE").collect()) == ["000111", "000112", "000113"]


def test_index_listing_sorted(spark):
    from periodica.operators.index import index_frame, index_listing
    idx = index_frame(spark, [(213, "B", "Mensual", True, None), (21, "A", "Semanal", True, None)])
    assert [r[0] for r in index_listing(idx).collect()] == [21, 213]


def test_ingest_spec_from_processor_json():
    """A processor config in the existing JSON shape becomes an IngestSpec."""
    text = """{
      "processor_name": "DEMO", "enabled": true, "file_pattern": "^DEMO.*\\\\.csv$",
      "read_options": {"delimiter": "|", "encoding": "utf-8"},
      "data_mapping": {"generate_uuid_if_id_missing": true,
        "column_map": {"Codigo": "CODIGO", "Fecha": "FECHA", "Monto": "MONTO"},
        "type_conversions": {"date_fields": ["FECHA"], "numeric_fields": ["MONTO"], "allow_empty": false},
        "final_db_columns": ["ID", "CODIGO", "FECHA", "MONTO", "FECHA_EXTRACCION"]},
      "db_config": {"schema": "LMDA", "table_name": "DEMO", "load_strategy": "append"}}"""
    spec = IngestSpec.from_json(text, types={"MONTO": "numeric(12,2)"})
    assert spec.file_type == "csv" and spec.delimiter == "|" and not spec.allow_empty
    assert dict(spec.column_map) == {"Codigo": "CODIGO", "Fecha": "FECHA", "Monto": "MONTO"}
    assert spec.landing == "LMDA.DEMO" and spec.landing_table == "l_lmda_demo"
    assert [f.name for f in spec.landing_schema().fields] == list(spec.final_columns)
    assert str(spec.landing_schema()["MONTO"].dataType) == "DecimalType(12,2)"


def test_workbook_date_serials(spark, lake):
    """Date cells stored as day serials in a workbook land as dates."""
    import dataclasses
    spec = dataclasses.replace(SPEC, name="TX", file_pattern=r"^T_.*\.xlsx$", file_type="excel",
                               landing="LMDA.TX")
    folder = unique_path(spark, "drop")
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, "T_1.xlsx")
    with open(p, "wb") as fh:
        fh.write(write_xlsx([["CODE", "Amount", "DAY"], ["000111", 1.5, 46129], ["000112", 2, "2026-04-18"]]))
    res = ingest(spark, lake, spec, [p])
    assert (res.accepted, res.rejected) == (2, 0)
    got = {r["CODE"]: r["DAY"] for r in spark.table(lake.fq("bronze", spec.landing_table)).collect()}
    assert got == {"000111": dt.date(2026, 4, 17), "000112": dt.date(2026, 4, 18)}


SHEET = ('<row r="1"><c r="A1" t="inlineStr"><is><t>A</t></is></c></row>{}'
         '<row r="9" spans="1:3"><c r="A9" s="1" t="s"><v>1</v></c><c r="C9" t="b"><v>1</v></c></row>')


def _book(sheet: str, head: str = '<?xml version="1.0" encoding="UTF-8"?>') -> bytes:
    import io
    import zipfile

    from periodica.sources import files
    main = files._NS["m"]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", files._WORKBOOK)
        z.writestr("xl/_rels/workbook.xml.rels", files._RELS)
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>x &amp; y</t></si><si><r><t>p</t></r><r><t>q</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'{head}<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')
    return out.getvalue()


def test_columns_of_a_sheet_are_its_rows(monkeypatch):
    """Whatever form its rows are in, a sheet read by column has the cells it has row by row."""
    from periodica.sources import files
    odd = ['<row r="2"/>', '<row r="2"><c r="B2" t="inlineStr"><is><t>a &amp;amp; &#233;&#xe9; &lt;</t></is></c></row>',
           '<!-- </row> <row> -->', '<row r="2"><c r="A2" t="inlineStr"><is><t><![CDATA[</row>]]></t></is></c></row>',
           '<row r="2"><c r="C2"><f>A1+1</f><v>7</v></c><c r="A2"><v>2</v></c></row>', '<row r="2"><c r="A2"><v></v></c><c r="B2"><v/></c></row>',
           '\n <row><c><v>1</v></c><c t="str"><v>r\r\ns</v></c></row>\n', '<row r="2"><c r="A2" s="4"/><c r="F2"><v>6</v></c></row>',
           '<row r="2"><c r="A2" t="inlineStr"><is><t xml:space="preserve"> t </t></is></c><c r="B2" t="inlineStr"><is><t></t></is></c></row>']
    heads = ["", '<?xml version="1.0" encoding="UTF-8"?>', "<?xml version='1.0' encoding='iso-8859-1'?>", "<!-- <sheetData> -->"]
    for part in (1 << 18, 40):
        monkeypatch.setattr(files, "SHEET_PART", part)
        for rows in [*odd, "".join(odd), ""]:
            for head in heads:
                data = _book(SHEET.format(rows), head)
                _, *want = ((*r, None, None, None)[:3] for r in xlsx_rows(data))
                got = [r for cols in files.sheet_columns(data, 3) for r in zip(*(c.to_pylist() for c in cols))]
                assert got == want and want[-1] == ("pq", None, "TRUE")


def test_plain_rows_are_not_parsed_one_by_one(monkeypatch):
    """Rows as most programs write them are taken apart by a pattern: the XML parser sees none of them."""
    from periodica.sources import files
    data = write_xlsx([["A", "B"], *[[f"a & {i}", i if i % 3 else None] for i in range(20_000)]])
    calls = []
    cells = files._cells
    monkeypatch.setattr(files, "_cells", lambda *a: calls.append(1) or cells(*a))
    got = [r for cols in files.sheet_columns(data, 2) for r in zip(*(c.to_pylist() for c in cols))]
    assert got == [(f"a & {i}", str(i) if i % 3 else None) for i in range(20_000)] and not calls


def test_a_worker_holds_a_workbook_or_two_and_not_all_of_its_task(spark, tmp_path):
    import pyarrow as pa
    for i in range(8):
        (tmp_path / f"{i}.xlsx").write_bytes(os.urandom(3 << 20))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        books = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
        assert books.rdd.getNumPartitions() == 1
        got = [r.n for r in books.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sum(got) == 8 and max(got) <= 2


def test_workbooks_are_written_in_parts(spark):
    from periodica.plans.ingest_queries import write_workbooks
    folder = unique_path(spark, "drop")
    cells = spark.range(5000).repartition(1).selectExpr("string(id) AS A", "nullif(string(id % 3), '0') AS B")
    write_workbooks(cells, folder, "x", most=2300)
    paths = [r.path for r in list_files(spark, folder).collect()]
    rows, bad = scan_workbook(spark, paths, None, ["A", "B"])
    assert len(paths) == 3 and not bad
    assert sorted((int(r.A), r.B) for r in rows.collect()) == [(i, str(i % 3) if i % 3 else None) for i in range(5000)]
