"""Data quality and layout conformance.

Column checks over data (V1, V2) are one global aggregation: every column's
counters are partial sums inside each task and only one row per task crosses
the shuffle, whatever the table size. Schema checks (V3-V6, V10) work on
``(name, ordinal, type, nullable)`` frames built from schemas and specs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.types import misfit, spark_type_to_coltype
from periodica.spec import ID_COL, LOAD_TS_COL, IngestSpec, LayoutColumn, ReportSpec

SCHEMA_FRAME = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
])


# -- V1 / V2 -----------------------------------------------------------------
def quality_scan(df: DataFrame, cols: Iterable[LayoutColumn]) -> DataFrame:
    """``(field, rule, n_rows)`` for NULLs in mandatory columns (V1, rule
    ``null``) and values that do not fit the declared type (V2, rule = type),
    computed in a single pass. Rows with a count of 0 are kept, so the output
    lists every check that ran."""
    aggs, labels = [], []
    types = {f.name: f.dataType for f in df.schema.fields}
    for i, c in enumerate(cols):
        if not c.nullable:
            aggs.append(F.count_if(F.col(c.name).isNull()).alias(f"_q{len(labels)}"))
            labels.append((c.name, "null"))
        if c.type.kind != "text":
            aggs.append(F.count_if(misfit(c.name, c.type, types.get(c.name))).alias(f"_q{len(labels)}"))
            labels.append((c.name, c.type.sql_name))
    one = df.agg(*aggs)
    pairs = [F.struct(F.lit(col).alias("field"), F.lit(rule).alias("rule"),
                      F.col(f"_q{i}").cast("long").alias("n_rows"))
             for i, (col, rule) in enumerate(labels)]
    return one.select(F.explode(F.array(*pairs)).alias("q")).select("q.*")


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """V1 wide form: one row, ``null_<column>`` per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in columns])


def quarantine(df: DataFrame, cols: Iterable[LayoutColumn]) -> tuple[DataFrame, DataFrame]:
    """Split rows into conforming ones and the rest with a ``_reason`` text."""
    from periodica.operators.conformance import violation_reason
    tagged = df.withColumn("_reason", violation_reason(list(cols)))
    return tagged.where(F.col("_reason") == "").drop("_reason"), tagged.where(F.col("_reason") != "")


# -- schema frames -----------------------------------------------------------
def schema_of_layout(spark: SparkSession, cols: Iterable[LayoutColumn]) -> DataFrame:
    rows = [(c.name, i + 1, c.type.sql_name, c.nullable) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, SCHEMA_FRAME)


def schema_of_frame(spark: SparkSession, schema: T.StructType, skip: Iterable[str] = ()) -> DataFrame:
    skip = set(skip)
    rows, i = [], 0
    for f in schema.fields:
        if f.name in skip:
            continue
        i += 1
        # a table declared VARCHAR(n) reads back as string; the declaration is
        # kept in the field metadata
        declared = (f.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING")
        t = declared.lower().replace(" ", "") if declared else spark_type_to_coltype(f.dataType).sql_name
        rows.append((f.name, i, t, f.nullable))
    return spark.createDataFrame(rows, SCHEMA_FRAME)


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """V3 / V4: full outer join of two schema frames by column name
    (case-insensitive, as the server resolves names) with one finding per
    difference: ``missing``, ``extra``, ``type``, ``nullable``, ``order``,
    ``case``. Returns ``(name, finding, expected, actual)``."""
    e = expected.select(F.lower("name").alias("k"), F.col("name").alias("e_name"),
                        F.col("ordinal").alias("e_ord"), F.col("type").alias("e_type"),
                        F.col("nullable").alias("e_null"))
    a = actual.select(F.lower("name").alias("k"), F.col("name").alias("a_name"),
                      F.col("ordinal").alias("a_ord"), F.col("type").alias("a_type"),
                      F.col("nullable").alias("a_null"))
    j = e.join(a, "k", "full_outer")
    name = F.coalesce("e_name", "a_name")
    s = F.col
    findings = F.array(
        F.when(s("a_name").isNull(), F.struct(F.lit("missing").alias("f"), s("e_type").alias("x"),
                                              F.lit(None).cast("string").alias("y"))),
        F.when(s("e_name").isNull(), F.struct(F.lit("extra").alias("f"),
                                              F.lit(None).cast("string").alias("x"), s("a_type").alias("y"))),
        F.when(s("e_name").isNotNull() & s("a_name").isNotNull() & (s("e_type") != s("a_type")),
               F.struct(F.lit("type").alias("f"), s("e_type").alias("x"), s("a_type").alias("y"))),
        F.when(s("e_name").isNotNull() & s("a_name").isNotNull() & (s("e_null") != s("a_null")),
               F.struct(F.lit("nullable").alias("f"), s("e_null").cast("string").alias("x"),
                        s("a_null").cast("string").alias("y"))),
        F.when(s("e_name").isNotNull() & s("a_name").isNotNull() & (s("e_ord") != s("a_ord")),
               F.struct(F.lit("order").alias("f"), s("e_ord").cast("string").alias("x"),
                        s("a_ord").cast("string").alias("y"))),
        F.when(s("e_name").isNotNull() & s("a_name").isNotNull() & (s("e_name") != s("a_name")),
               F.struct(F.lit("case").alias("f"), s("e_name").alias("x"), s("a_name").alias("y"))),
    )
    return (j.select(name.alias("name"), F.explode(F.filter(findings, lambda x: x.isNotNull())).alias("d"))
            .select("name", F.col("d.f").alias("finding"), F.col("d.x").alias("expected"),
                    F.col("d.y").alias("actual")))


def table_vs_layout(spark: SparkSession, df: DataFrame, spec: ReportSpec) -> DataFrame:
    """V3 for a stored report: its columns (audit and partition columns aside)
    against the stored layout."""
    actual = schema_of_frame(spark, df.schema, skip=(ID_COL, LOAD_TS_COL, "period_start"))
    return schema_diff(schema_of_layout(spark, spec.stored_columns), actual)


def landing_vs_report(spark: SparkSession, ingest: IngestSpec, spec: ReportSpec) -> DataFrame:
    """V4: declared landing types against report types for shared columns."""
    renames = dict(spec.load_renames)
    nums, texts = dict(ingest.numeric_fields), dict(ingest.text_fields)
    rows, i = [], 0
    for c in ingest.final_columns:
        if c in (ID_COL, LOAD_TS_COL):
            continue
        i += 1
        if c in ingest.date_fields:
            t = "date"
        elif c in nums:
            t = nums[c].replace(" ", "")
        elif c in texts:
            t = f"varchar({texts[c]})"
        else:
            t = "text"
        rows.append((renames.get(c, c), i, t, True))
    actual = spark.createDataFrame(rows, SCHEMA_FRAME)
    exp = schema_of_layout(spark, spec.stored_columns)
    return schema_diff(exp, actual).where(F.col("finding") == "type")


# -- spec checks (V5, V6, V10) ---------------------------------------------
def spec_findings(spec: ReportSpec, ingest: IngestSpec | None = None) -> list[tuple[str, str]]:
    """Rules about the spec itself: audit column delivered (V5), information
    date not last (V6), control column never reaches landing (V10)."""
    out = []
    headers = [c.header for c in spec.columns]
    for audit in (ID_COL, LOAD_TS_COL):
        if audit in headers:
            out.append(("V5", f"audit column {audit} is delivered"))
    info = [h for h in headers if h.upper() in ("FECHA_INFO", "FECHAINFO")]
    if info and headers[-1] != info[0]:
        out.append(("V6", f"{info[0]} is not the last delivered column"))
    if ingest is not None and spec.control != LOAD_TS_COL:
        renames = {stored: land for land, stored in spec.load_renames}
        ctrl = renames.get(spec.control, spec.control)
        if ctrl not in ingest.final_columns and ingest.control_from != "run_date":
            out.append(("V10", f"control column {ctrl} is not in the landing columns"))
    return out


def landing_coverage(landing: DataFrame, spec: ReportSpec) -> DataFrame:
    """landing rows per window of the report, with the rows whose control
    date is NULL in their own bucket (``window_start`` NULL, ``null_control``
    true); those rows never enter any window, so the loss stays visible."""
    from periodica.functions.periods import period_start
    renames = {stored: land for land, stored in spec.load_renames}
    control = renames.get(spec.control, spec.control)
    ps = period_start(control, spec.frequency)
    return (landing.groupBy(ps.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("null_control", F.col("window_start").isNull()))
