"""Report index (S16-S18): one row per report ``(numero, nombre, frecuencia,
activo, nombre_archivo)``.

The index is small by nature (hundreds of rows), but every operation is still a
DataFrame plan (full outer join + coalesce, conditional update with a count of
changed rows, delete by key) so it runs the same on the cluster and rewrites
the table in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX_SCHEMA = T.StructType([
    T.StructField("numero", T.IntegerType(), False),
    T.StructField("nombre", T.StringType(), False),
    T.StructField("frecuencia", T.StringType(), False),
    T.StructField("activo", T.BooleanType(), False),
    T.StructField("nombre_archivo", T.StringType(), True),
])
FIELDS = [f.name for f in INDEX_SCHEMA.fields]


def index_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, INDEX_SCHEMA)


def index_upsert(index: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert new ``numero`` values, overwrite every field of existing ones
    (the legacy upsert sets all fields, NULL included, on update)."""
    i, c = index.alias("i"), changes.alias("c")
    j = i.join(c, F.col("i.numero") == F.col("c.numero"), "full_outer")
    hit = F.col("c.numero").isNotNull()
    return j.select(*[F.when(hit, F.col(f"c.{f}")).otherwise(F.col(f"i.{f}")).alias(f)
                      for f in FIELDS])


def index_update(index: DataFrame, numero: int, column: str, value) -> tuple[DataFrame, Column]:
    """Set ``column`` to ``value`` for ``numero`` only where it differs.
    Returns the new index and a boolean ``changed`` column for counting."""
    lit = F.lit(value).cast(dict((f.name, f.dataType) for f in INDEX_SCHEMA.fields)[column])
    cond = (F.col("numero") == F.lit(numero)) & ~F.col(column).eqNullSafe(lit)
    new = index.withColumn("_changed", cond).withColumn(
        column, F.when(F.col("_changed"), lit).otherwise(F.col(column)))
    return new, F.col("_changed")


def index_delete(index: DataFrame, numero: int) -> DataFrame:
    """Remove one report from the index."""
    return index.where(F.col("numero") != F.lit(numero))


def rewrite_index(spark: SparkSession, table: str, new: DataFrame) -> None:
    """Replace the small index table; the new content is materialised in the
    shared folder first because it is computed from the table it overwrites."""
    from periodica.session import delete_path, unique_path
    path = unique_path(spark, "index")
    new.select(*FIELDS).write.parquet(path)
    try:
        spark.read.parquet(path).write.mode("overwrite").saveAsTable(table)
    finally:
        delete_path(spark, path)


def index_listing(index: DataFrame) -> DataFrame:
    """A5: the index as listed before and after a change, ordered by number."""
    return index.orderBy(F.col("numero").asc())
