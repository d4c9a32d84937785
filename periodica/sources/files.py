"""File sources: routing by name (S1), delimited scan (S2), workbook scan (S3).

All three return DataFrames of *text* cells keyed by the file's own header, so
the column map (S4) can work by declared name, never by position, and zero-led
codes such as ``000111`` stay text until the typed conversion.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import partial
from itertools import chain, islice
from typing import IO
from urllib.parse import unquote
from xml.etree import ElementTree as ET

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.spec import SOURCE_FILE_COL, IngestSpec

CORRUPT_COL = "_corrupt_record"


# -- S1: route --------------------------------------------------------------
def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(path, name, length, modificationTime) of every file under ``folder``.

    ``binaryFile`` lists in parallel for large folders; the ``content`` column
    is never selected, so no file body is read here.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(folder).select("path", "length", "modificationTime")
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1))


def route(files: DataFrame, specs: Iterable[IngestSpec]) -> DataFrame:
    """Match each file's base name against the anchored pattern of every enabled
    spec. Output ``(path, name, spec, n_matches)``; a file must match exactly
    one spec (``n_matches`` = 1), others are left for the caller to report."""
    specs = [s for s in specs if s.enabled]
    if not specs:
        return files.select("path", "name", F.lit(None).cast("string").alias("spec"),
                            F.lit(0).alias("n_matches"))
    matches = F.array(*[F.when(F.col("name").rlike(s.file_pattern), F.lit(s.name))
                        for s in specs])
    hits = F.filter(matches, lambda x: x.isNotNull())
    return (files.withColumn("_hits", hits)
            .select("path", "name",
                    F.when(F.size("_hits") == 1, F.col("_hits")[0]).alias("spec"),
                    F.size("_hits").alias("n_matches")))


# -- headers ----------------------------------------------------------------
def first_lines(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """(path, header): the first line that is not blank of every file, read in tasks.

    A file may be cut into splits: the line is the one of lowest row number in the
    file's first split. This is one more pass over the bytes, which only parts lines;
    Spark's readers cannot stop after one.
    """
    lines = (spark.read.schema("value STRING").option("sep", "\u0001").option("quote", "\u0000")
             .option("encoding", encoding).csv(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value"))
    first = (lines.where(F.col("at") == 0).withColumn("i", F.monotonically_increasing_id())
             .groupBy("path").agg(F.min_by("value", "i").alias("header")))
    return first.select("path", F.regexp_replace(F.col("header"), "^\ufeff", "").alias("header"))


def header_groups(headers: DataFrame) -> dict[str, list[str]]:
    """The files of each distinct header. Grouped on Spark; the paths come along for
    the reader, which lists them on the driver in any case."""
    rows = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return {r["header"]: [plain_path(p) for p in r["paths"]] for r in sorted(rows, key=lambda r: r["header"] or "")}


def plain_path(p: str) -> str:
    """A path as readers take it, from a file's metadata, which escapes it."""
    return re.sub("^file:/+", "file:/", unquote(p))


# -- S2: delimited ----------------------------------------------------------
def scan_delimited(spark: SparkSession, paths: list[str], spec: IngestSpec,
                   required: list[str] | None = None) -> tuple[DataFrame | None, dict]:
    """All cells as text, columns named by each file's header.

    Files are grouped by identical header line and each group is read with an
    explicit all-string schema in that header's order (no inference, no
    positional guessing across different headers). Malformed lines land in
    ``_corrupt_record`` instead of failing the job. A file whose header lacks a
    ``required`` name, or that has no line, is not read; it is returned in the
    second value as ``{path: [missing names]}``.
    """
    if not paths:
        return None, {}
    groups = header_groups(first_lines(spark, paths, spec.encoding))
    frames, seen = [], {p for g in groups.values() for p in g}
    rejected = {p: list(required or []) for p in paths if plain_path(p) not in seen}
    for header, group in groups.items():
        names = [h.strip() for h in (header or "").split(spec.delimiter)]
        missing = [r for r in (required or []) if r not in names]
        if missing:
            rejected.update({p: missing for p in group})
            continue
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                              + [T.StructField(CORRUPT_COL, T.StringType(), True)])
        df = (spark.read.schema(schema)
              .option("sep", spec.delimiter).option("header", True)
              .option("encoding", spec.encoding).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL)
              .option("quote", "\u0000").option("enforceSchema", True)
              .csv(group))
        frames.append(df.withColumn(SOURCE_FILE_COL, F.input_file_name()))
    return _union(frames), rejected


def _union(frames: list[DataFrame]) -> DataFrame | None:
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# -- S3: workbook (.xlsx) ---------------------------------------------------
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_CELL_RE = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    letters = _CELL_RE.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_name(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    first = wb.find("m:sheets/m:sheet", _NS)
    rid = first.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    return "xl/worksheets/sheet1.xml"


class SharedStrings:
    """A workbook's table of shared strings, as UTF-8 in one block: no object for each."""

    def __init__(self) -> None:
        self.text, self.ends = bytearray(), array("q", [0])

    def add(self, s: str) -> None:
        self.text += s.encode()
        self.ends.append(len(self.text))

    def __getitem__(self, i: int) -> str:
        return self.text[self.ends[i]:self.ends[i + 1]].decode()


def _shared_strings(z: zipfile.ZipFile) -> SharedStrings:
    out, tag = SharedStrings(), f"{{{_NS['m']}}}si"
    if "xl/sharedStrings.xml" not in z.namelist():
        return out
    with z.open("xl/sharedStrings.xml") as f:
        root = None         # of the strings: an element that grows unless they are removed
        for event, el in ET.iterparse(f, events=("start", "end")):
            if root is None:
                root = el
            if event == "end" and el.tag == tag:
                out.add("".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t")))
                root.clear()
    return out


_ROW, _C, _V, _IS, _T = (f"{{{_NS['m']}}}{x}" for x in ("row", "c", "v", "is", "t"))


def _cells(row: ET.Element, shared: SharedStrings, columns: dict[str, int]) -> list[str | None]:
    """The cells of a row; ``columns`` keeps the places of the letters seen so far."""
    out: list[str | None] = []
    digits = len(row.get("r", ""))
    for c in row:
        if c.tag != _C:
            continue
        kind, ref, at = c.get("t"), c.get("r"), len(out)
        if kind == "inlineStr":
            own = c.find(_IS)
            if own is None:
                val = None
            elif len(own) == 1 and own[0].tag == _T:
                val = own[0].text or ""
            else:
                val = "".join(x.text or "" for x in own.iter(_T))
        else:
            v = c.find(_V)
            val = v.text if v is not None else None
            if kind == "s" and val is not None:
                val = shared[int(val)]
            elif kind == "b" and val is not None:
                val = "TRUE" if val == "1" else "FALSE"
        if ref:
            letters = ref[:-digits] if digits else ref
            at = columns.get(letters, -1)
            if at < 0:
                at = columns[letters] = _col_index(ref)
        if at < len(out):
            out[at] = val
        else:
            if at > len(out):
                out.extend([None] * (at - len(out)))
            out.append(val)
    return out


def _sheet(blocks: Iterable[bytes], shared: SharedStrings) -> Iterator[list[str | None]]:
    """The rows of a sheet that comes in blocks, each of which is dropped once it has been read."""
    columns, sheet, builder = {}, None, ET.TreeBuilder()
    top = builder.start("top", {})      # holds the document, so that it can be read while it grows
    parser = ET.XMLParser(target=builder)
    for block in blocks:
        parser.feed(block)
        if sheet is None:
            sheet = top.find(f"*/{{{_NS['m']}}}sheetData")
        if sheet is not None and len(sheet) > 1:
            done = sheet[:-1]       # the last row may not be complete
            del sheet[:-1]
            yield from (_cells(r, shared, columns) for r in done if r.tag == _ROW)
    builder.end("top")
    parser.close()
    if sheet is not None:
        yield from (_cells(r, shared, columns) for r in sheet if r.tag == _ROW)


def _blocks(f: IO[bytes]) -> Iterator[bytes]:
    return iter(lambda: f.read(SHEET_BLOCK), b"")


def xlsx_rows(data: bytes | pa.Buffer) -> Iterator[list[str | None]]:
    """Cells of the first sheet as text (shared, inline and number cells), row by row.

    The sheet is parsed block by block and its rows are dropped once they have been
    read, so a caller holds the rows of one block, and may stop early; besides the file
    itself only its table of shared strings is kept."""
    with zipfile.ZipFile(pa.BufferReader(data)) as z, z.open(_first_sheet_name(z)) as f:
        yield from _sheet(_blocks(f), _shared_strings(z))


# a cell in the form that most programs write, or none: its type where its value has one, and its text
_CELL_FORM = (r'(?:<c r="%s[0-9]++"(?: s="[0-9]++")?+(?:/>|(?: t="inlineStr"><is><t(?: xml:space="preserve")?+>'
              r'|(?: t="(s|b|n|str|e|d)")?+><v>(?!<))([^<\r]*+)(?:</t></is>|</v>)</c>))?+')
_ROW_END = b"</row>"
_OTHER_ENCODING = re.compile(rb"encoding\s*=\s*[\"'](?!utf-8[\"'])", re.IGNORECASE)
_ENTITY = re.compile("&(?:#([0-9]+)|#x([0-9A-Fa-f]+)|(amp|lt|gt|quot|apos));")
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _unescaped(s: str | None) -> str | None:
    if s is None or "&" not in s:
        return s
    return _ENTITY.sub(lambda m: _ENTITIES[m[3]] if m[3] else chr(int(m[1]) if m[1] else int(m[2], 16)), s)


def _value(kind: str | None, text: str | None, shared: SharedStrings) -> str | None:
    if kind == "s":
        return shared[int(text)]
    return ("TRUE" if text == "1" else "FALSE") if kind == "b" else text


def _forms(rows: list[list[str | None]], width: int) -> list[tuple[str | None, ...]]:
    """Rows of cells as a match of ``_CELL_FORM`` for each of the first ``width`` columns gives them."""
    return [tuple(x for c in (*r[:width], *[None] * (width - len(r))) for x in (None, c)) for r in rows]


def _columns(rows: list[tuple[str | None, ...]], shared: SharedStrings) -> list[pa.Array]:
    cells, out = list(zip(*rows)), []
    for kinds, texts in zip(cells[::2], cells[1::2]):
        out.append(pa.array([_value(k, x, shared) for k, x in zip(kinds, texts)] if any(kinds) else texts, pa.string()))
    return out


def _row_forms(f: IO[bytes], width: int, shared: SharedStrings) -> Iterator[list[tuple[str | None, ...]]]:
    """All rows of a sheet, some at a time.

    One pattern takes apart the rows in the form that most programs write. A row of
    another form is parsed as XML by itself; from the first place that is no row
    (a comment, say), or in another encoding than UTF-8, the parser of
    ``xlsx_rows`` reads all that follows."""
    pattern = re.compile('[ \t\n\r]*+<row(?: [^<>/]*+)?+>' + "".join(_CELL_FORM % _letters(i) for i in range(width)) + "</row>")
    left, mark = f.read(SHEET_PART), b"<sheetData>"
    start = left.find(mark) + len(mark)
    top, left = left[:start], left[start:]
    plain = (top.endswith(mark) and b"<!" not in top and f'xmlns="{_NS["m"]}"'.encode() in top
             and not _OTHER_ENCODING.search(top))
    while plain:
        if b"<!" in left or b"<?" in left:
            break
        end = left.rfind(_ROW_END) + len(_ROW_END)
        if end < len(_ROW_END):
            if not (more := f.read(SHEET_PART)):
                break
            left += more        # the end of a row longer than that is to come
            continue
        text, at, rows = left[:end].decode(), 0, []
        escaped = "&" in text
        while at < len(text):
            if m := pattern.match(text, at):
                rows.append(tuple(map(_unescaped, m.groups())) if escaped else m.groups())
                at = m.end()
                continue
            end_at = text.index("</row>", at) + len("</row>")
            one = text[at:end_at].strip(" \t\n\r")
            if not one.startswith(("<row>", "<row ", "<row/")):
                plain = False
                break
            rows += _forms(list(_sheet([top, one.encode(), b"</sheetData></worksheet>"], shared)), width)
            at = end_at
        yield rows
        left = text[at:].encode() + left[end:] + f.read(SHEET_PART)
    rest = _sheet(chain([top, left], _blocks(f)), shared)
    while some := list(islice(rest, SHEET_ROWS)):
        yield _forms(some, width)


def sheet_columns(data: bytes | pa.Buffer, width: int) -> Iterator[list[pa.Array]]:
    """``xlsx_rows`` by column: the first ``width`` of them, without the first row, many rows at a time."""
    with zipfile.ZipFile(pa.BufferReader(data)) as z, z.open(_first_sheet_name(z)) as f:
        shared = _shared_strings(z)
        rows = islice(chain.from_iterable(_row_forms(f, width, shared)), 1, None)
        while some := list(islice(rows, SHEET_ROWS)):
            yield _columns(some, shared) if width else [pa.nulls(len(some))]


SHEET_ROWS = 1000       # that a task hands over at once
SHEET_BLOCK = 1 << 14   # bytes of a sheet parsed at once: a few rows, which stay in the processor's cache
SHEET_PART = 1 << 18    # bytes of a sheet that a pattern takes apart at once


def _sheet_rows(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows below the header of each workbook (path, content), by column."""
    names = [SOURCE_FILE_COL, *(f"c{i}" for i in range(width))]
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            for columns in sheet_columns(content.as_buffer(), width):
                paths = pa.array([path]).take(pa.array([0] * len(columns[0])))
                yield pa.RecordBatch.from_arrays([paths, *columns][:len(names)], names=names)


def _sheet_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, header as JSON): the first row of each workbook; nothing else of it is parsed."""
    for b in batches:
        paths = b.column(0).to_pylist()
        first = [[(h or "").strip() for h in next(xlsx_rows(c.as_buffer()), [])] for c in b.column(1)]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([json.dumps(h) for h in first], pa.string())],
                                         names=["path", "header"])


def scan_workbook(spark: SparkSession, paths: list[str], spec: IngestSpec | None = None,
                  required: list[str] | None = None) -> tuple[DataFrame | None, dict]:
    """First sheet of each ``.xlsx`` as text cells named by its header row.

    Workbooks are spread over tasks (``binaryFile``) and parsed with the standard
    library (``zipfile``, patterns, XML events). A first pass reads the header row of each, and
    workbooks are grouped by it as delimited files are; the second reads the rows.
    Nothing is kept between the two. Legacy binary ``.xls`` is not read. Same return
    shape as ``scan_delimited``.
    """
    rejected = {p: ["legacy .xls is not read"] for p in paths if not p.lower().endswith(".xlsx")}
    paths = [p for p in paths if p.lower().endswith(".xlsx")]
    if not paths:
        return None, rejected

    # no repartition: that would shuffle whole file bodies; the binaryFile scan already
    # packs workbooks into tasks by size (maxPartitionBytes)
    def books(group: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").load(group).select("path", "content")
    headers = books(paths).mapInArrow(_sheet_headers, "path string, header string")
    frames = []
    for header, group in header_groups(headers).items():
        names = json.loads(header)
        missing = [r for r in (required or []) if r not in names]
        if missing:
            rejected.update({p: missing for p in group})
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (SOURCE_FILE_COL, *(f"c{i}" for i in range(len(names))))])
        sel = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n]
        frames.append(books(group).mapInArrow(partial(_sheet_rows, len(names)), schema)
                      .select(*sel, F.lit(None).cast("string").alias(CORRUPT_COL), SOURCE_FILE_COL))
    return _union(frames), rejected


_WORKBOOK = ('<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="%s" xmlns:r="%s">'
            '<sheets><sheet name="Hoja1" sheetId="1" r:id="rId1"/></sheets></workbook>'
            % (_NS["m"], _NS["r"]))
_RELS = ('<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.'
        'openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
        'worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
_TYPES = ('<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxml'
          'formats.org/package/2006/content-types"><Default Extension="xml" ContentType='
          '"application/xml"/><Default Extension="rels" ContentType="application/vnd.'
          'openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" '
          'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.'
          'main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/'
          'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')


def _letters(ci: int) -> str:
    s, n = "", ci + 1
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return s


def text_rows(b: pa.RecordBatch, first: int) -> bytes:
    """The rows of a batch of text columns as XML of a sheet, numbered from ``first``; null: no cell."""
    number = pa.array(range(first, first + b.num_rows)).cast(pa.string())
    cells = [pc.binary_join_element_wise('<row r="', number, '">', "")]
    for ci, c in enumerate(b.columns):
        for a, x in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = pc.replace_substring(c, a, x)
        cells.append(pc.fill_null(pc.binary_join_element_wise(
            f'<c r="{_letters(ci)}', number, '" t="inlineStr"><is><t>', c, "</t></is></c>", ""), ""))
    return b"".join(x.as_buffer() for x in pc.binary_join_element_wise(*cells, "</row>", "").cast(pa.binary()))


def text_row(values: Sequence, ri: int) -> bytes:
    """A row as XML of a sheet: text as inline strings, numbers as number cells; None: no cell."""
    def cell(ci: int, v) -> str:
        if isinstance(v, int | float) and not isinstance(v, bool):
            return f'<c r="{_letters(ci)}{ri}"><v>{v}</v></c>'
        v = str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        return f'<c r="{_letters(ci)}{ri}" t="inlineStr"><is><t>{v}</t></is></c>'
    return f'<row r="{ri}">{"".join(cell(ci, v) for ci, v in enumerate(values) if v is not None)}</row>'.encode()


def write_sheet(out: IO[bytes], rows: Iterable[bytes]) -> None:
    """Write a minimal single-sheet workbook of rows in XML (used to make test inputs; the
    engine itself only reads workbooks). They are compressed as they come, none is kept."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        z.writestr("[Content_Types].xml", _TYPES)
        z.writestr("xl/workbook.xml", _WORKBOOK)
        z.writestr("xl/_rels/workbook.xml.rels", _RELS)
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS["m"]}"><sheetData>'.encode())
            for r in rows:
                f.write(r)
            f.write(b"</sheetData></worksheet>")


def write_xlsx(rows: Iterable[Sequence]) -> bytes:
    """The bytes of a workbook of these rows."""
    buf = io.BytesIO()
    write_sheet(buf, (text_row(r, ri) for ri, r in enumerate(rows, 1)))
    return buf.getvalue()
