"""Schema evolution of stored reports (E1-E20): a migration is a list of steps
applied as one projection, then one distributed rewrite of the table.

Every step is idempotent: it looks at the current schema and does nothing when
its change is already there, so running a migration twice equals running it
once. Steps that can lose data (kind change, narrowing) collect the values that
do not convert; the table is only swapped when there are none (or, for the
truncating narrow, the changed rows are reported).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from periodica.functions.types import parse_type
from periodica.session import LOCATION_SUFFIX, delete_path, read_lines, unique_path, write_lines
from periodica.sources.tables import NOT_NULL
from periodica.sources.versions import forget_windows, sync_windows, table_location
from periodica.spec import PERIOD_COL


@dataclass(frozen=True)
class AddColumn:            # E1 nullable, E2 marker default, E3 back-fill only, E15
    name: str
    type_text: str
    default: object = None


@dataclass(frozen=True)
class Rename:               # E4, E5 (case only), E6 (reverse of an earlier rename)
    old: str
    new: str


@dataclass(frozen=True)
class Drop:                 # E8
    names: tuple[str, ...]


@dataclass(frozen=True)
class Retype:               # E9 widen, E10 change kind, E14 narrow without loss
    name: str
    type_text: str


@dataclass(frozen=True)
class Truncate:             # E13 narrow text with LEFT(x, n)
    name: str
    length: int


@dataclass(frozen=True)
class Backfill:             # E11 NULL -> value before tightening to NOT NULL
    name: str
    value: object


@dataclass(frozen=True)
class Tighten:              # E12 NULL -> NOT NULL; refused while a NULL is there
    name: str


@dataclass(frozen=True)
class Loosen:               # E12 NOT NULL -> NULL
    name: str


@dataclass
class Plan:
    """The steps folded into one projection, and what may speak against them."""
    columns: list[Column]
    conversions: list[tuple[str, Column, Column]]       # column, source value, converted value
    truncations: list[tuple[str, Column, Column]]       # column, TRUE when changed, old value
    tightened: list[tuple[str, Column]]                 # column, new value: must not be NULL


def _find(cols: list[str], name: str) -> str | None:
    for c in cols:
        if c == name:
            return c
    for c in cols:
        if c.lower() == name.lower():
            return c
    return None


def plan_columns(df: DataFrame, steps) -> Plan:
    """Fold the steps into one projection. A row loses data where the source of a
    conversion is not NULL and the converted value is."""
    cols: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    conversions, truncations, tight = [], [], []
    for st in steps:
        names = list(cols)
        if isinstance(st, AddColumn):
            if _find(names, st.name) is None:
                t = parse_type(st.type_text).spark
                cols[st.name] = F.lit(st.default).cast(t)
                types[st.name] = t
        elif isinstance(st, Rename):
            old = _find(names, st.old)
            exact_new = st.new in names
            if old is not None and not exact_new and (old.lower() == st.new.lower()
                                                       or _find(names, st.new) is None):
                cols = {(st.new if k == old else k): v for k, v in cols.items()}
                types[st.new] = types.pop(old)
        elif isinstance(st, Drop):
            for n in st.names:
                k = _find(list(cols), n)
                if k is not None:
                    cols.pop(k)
                    types.pop(k, None)
        elif isinstance(st, Retype):
            k = _find(names, st.name)
            if k is None:
                continue
            t = parse_type(st.type_text)
            target = t.spark
            if types.get(k) == target and t.kind != "varchar":
                continue
            src = cols[k]
            if t.kind == "varchar":
                conv = src.cast("string")
                lost = F.length(conv) > t.length
                cols[k] = F.when(~lost, conv)
                conversions.append((k, src, cols[k]))
            else:
                conv = src.try_cast(target)
                if t.kind == "numeric":
                    # a value that the declared scale would round is lost too
                    exact = src.try_cast("decimal(38,18)")
                    conv = F.when(exact.isNull() | (conv.cast("decimal(38,18)") == exact), conv)
                conversions.append((k, src, conv))
                cols[k] = conv
            types[k] = target
        elif isinstance(st, Truncate):
            k = _find(names, st.name)
            if k is None:
                continue
            src = cols[k].cast("string")
            truncations.append((k, F.length(src) > st.length, src))
            cols[k] = F.substring(src, 1, st.length)
        elif isinstance(st, Backfill):
            k = _find(names, st.name)
            if k is not None:
                cols[k] = F.coalesce(cols[k], F.lit(st.value).cast(types[k]))
        elif isinstance(st, Tighten):
            k = _find(names, st.name)
            if k is not None:
                tight.append((k, cols[k]))
    return Plan([v.alias(k) for k, v in cols.items()], conversions, truncations, tight)


def declared_layout(spark: SparkSession, table: str) -> tuple[dict[str, str], set[str]]:
    """Declared type of each column (``varchar(3)``, not its storage type), and the
    columns that must not be NULL, from the catalog."""
    types = {}
    for r in spark.sql(f"DESCRIBE TABLE {table}").collect():
        if not r["col_name"] or r["col_name"].startswith("#"):
            break
        types[r["col_name"]] = r["data_type"]
    row = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == NOT_NULL).first()
    return types, set(filter(None, row["value"].split(","))) if row else set()


def plan_layout(types: dict[str, str], required: set[str], steps) -> tuple[dict[str, str], set[str]]:
    """The declared layout after the steps."""
    types, required = dict(types), set(required)
    for st in steps:
        if isinstance(st, AddColumn):
            if _find(list(types), st.name) is None:
                types[st.name] = parse_type(st.type_text).ddl
        elif isinstance(st, Rename):
            old = _find(list(types), st.old)
            if old is not None and st.new not in types and (old.lower() == st.new.lower() or _find(list(types), st.new) is None):
                types = {(st.new if k == old else k): v for k, v in types.items()}
                required = {st.new if k == old else k for k in required}
        elif isinstance(st, Drop):
            gone = {_find(list(types), n) for n in st.names}
            types, required = {k: v for k, v in types.items() if k not in gone}, required - gone
        elif k := _find(list(types), getattr(st, "name", "")):
            if isinstance(st, Retype):
                types[k] = parse_type(st.type_text).ddl
            elif isinstance(st, Truncate):
                types[k] = f"VARCHAR({st.length})"
            elif isinstance(st, Tighten):
                required.add(k)
            elif isinstance(st, Loosen):
                required.discard(k)
    return types, required


def migrate(df: DataFrame, steps) -> DataFrame:
    """The migrated frame (lazy); values that do not convert become NULL, see
    ``migration_rejects`` for the rows that would lose data."""
    return df.select(*plan_columns(df, steps).columns)


def migration_rejects(df: DataFrame, steps, keys: list[str]) -> DataFrame:
    """Rows that lose a value in a type change (E10, E14), or hold a NULL that a
    tightening forbids (E12): ``keys..., field, value``. An empty result means the
    migration is lossless."""
    plan = plan_columns(df, steps)
    found = [F.when(src.isNotNull() & conv.isNull(), F.struct(F.lit(name).alias("field"), src.cast("string").alias("value")))
             for name, src, conv in plan.conversions]
    found += [F.when(value.isNull(), F.struct(F.lit(name).alias("field"), F.lit(None).cast("string").alias("value")))
              for name, value in plan.tightened]
    if not found:
        return df.limit(0).select(*keys, F.lit("").alias("field"), F.lit("").alias("value"))
    items = F.array(*found)
    return (df.select(*keys, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("r"))
            .select(*keys, "r.field", "r.value"))


def truncated_rows(df: DataFrame, steps, keys: list[str]) -> DataFrame:
    """Rows whose text a narrowing step cuts (E13), with the old value."""
    truncs = plan_columns(df, steps).truncations
    if not truncs:
        return df.limit(0).select(*keys, F.lit("").alias("field"), F.lit("").alias("value"))
    items = F.array(*[F.when(cond, F.struct(F.lit(n).alias("field"),
                                            src.alias("value")))
                      for n, cond, src in truncs])
    return (df.select(*keys, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("r"))
            .select(*keys, "r.field", "r.value"))


def migrate_table(spark: SparkSession, table: str, steps, keys: list[str],
                  new_name: str | None = None, allow_truncation: bool = True) -> dict:
    """Rewrite a catalog table with the migrated schema and swap it in.

    One pass: the new version is written next to the old folder while an
    ``Observation`` counts values a type change would lose (E10, E14), NULLs that a
    tightening forbids (E12) and texts a narrowing cuts (E13). A version with losses is discarded before
    any swap and the rejects are returned (computed lazily from the untouched
    table); otherwise the old definition is dropped and the new one renamed
    into place (or to ``new_name``, E7). A swap interrupted between the two
    catalog calls is completed by the next run. Aborts when the table is
    missing (E19).
    """
    recover_swap(spark, table)
    if not spark.catalog.tableExists(table):
        raise LookupError(f"table {table} does not exist")
    sync_windows(spark, table, table_location(spark, table))
    df = spark.table(table)
    plan = plan_columns(df, steps)
    lost = F.lit(False)
    for _, src, conv in plan.conversions:
        lost = lost | (src.isNotNull() & conv.isNull())
    cut = F.lit(False)
    for _, cond, _ in plan.truncations:
        cut = cut | F.coalesce(cond, F.lit(False))
    null = F.lit(False)
    for _, value in plan.tightened:
        null = null | value.isNull()
    obs = Observation("migrate")
    out = (df.select(*plan.columns, lost.alias("_lost"), cut.alias("_cut"), null.alias("_null"))
           .observe(obs, *[F.count_if(F.col(f"_{c}")).alias(c) for c in ("lost", "cut", "null")])
           .drop("_lost", "_cut", "_null"))
    staged, path = write_version(spark, table, out, *plan_layout(*declared_layout(spark, table), steps))
    m = obs.get
    if m["lost"] or m["null"] or (m["cut"] and not allow_truncation):
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        delete_path(spark, path)
        return {"status": "Error", "table": table, "lost": int(m["lost"]), "truncated": int(m["cut"]),
                "nulls": int(m["null"]), "rejects": migration_rejects(df, steps, keys)}
    final = swap_in(spark, table, staged, new_name)
    return {"status": "Exitoso", "table": final, "truncated": int(m["cut"])}


def _staged_name(table: str) -> str:
    db, _, name = table.rpartition(".")
    return f"{db + '.' if db else ''}{name}__new"


def write_version(spark: SparkSession, table: str, df: DataFrame, types: dict[str, str] | None = None,
                  required: set[str] = frozenset()) -> tuple[str, str]:
    """Write ``df`` as a new version of ``table`` in a fresh folder next to the old one
    (partitioned by ``period_start`` when present). The table is created from its
    declared layout and then filled, so that ``varchar(n)`` and what must not be NULL
    stay in the catalog (E9, E12). Other tables' writers share no folder with this one."""
    if types is None:
        types, required = declared_layout(spark, table)
    staged = _staged_name(table)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    name = table.rpartition(".")[2]
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    root = loc["data_type"].rsplit("/", 1)[0] if loc else unique_path(spark, "migrate")
    path = f"{root}/{name}__{unique_path(spark, 'v').rsplit('/', 1)[-1]}"
    cols = ", ".join(f"`{f.name}` {types.get(f.name, f.dataType.simpleString())}" for f in df.schema.fields)
    parts = f"PARTITIONED BY ({PERIOD_COL})" if PERIOD_COL in df.columns else ""
    held = ",".join(sorted(c for c in required if c in df.columns))
    spark.sql(f"CREATE TABLE {staged} ({cols}) USING parquet {parts} LOCATION '{path}' TBLPROPERTIES ('{NOT_NULL}' = '{held}')")
    if PERIOD_COL in df.columns:  # a few right-sized files per window, not one per task and window
        df = df.hint("rebalance", PERIOD_COL)
    df.select(*[f"`{c}`" for c in spark.table(staged).columns]).write.insertInto(staged, overwrite=False)
    return staged, path


def swap_in(spark: SparkSession, table: str, staged: str, new_name: str | None = None) -> str:
    """Drop the old definition and rename the new version into place.

    Between the two calls no table has the name; ``recover_swap`` completes a swap
    that broke off there. The new folder is noted next to it, so that a later
    session attaches it; the folder that was in use stays for readers that are
    still open, and goes with the next migration."""
    old, new = _location(spark, table), _location(spark, staged)
    spark.sql(f"DROP TABLE {table}")
    final = new_name or table
    spark.sql(f"ALTER TABLE {staged} RENAME TO {final}")
    forget_windows(spark, table)
    forget_windows(spark, final)
    _note_location(spark, table, final, new, old)
    return final


def _location(spark: SparkSession, table: str) -> str | None:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return row["data_type"].rstrip("/") if row else None


def _note_location(spark: SparkSession, table: str, final: str, new: str, old: str | None) -> None:
    root = new.rsplit("/", 1)[0]
    before = f"{root}/{table.rpartition('.')[2]}{LOCATION_SUFFIX}"
    for stale in read_lines(spark, before)[1:]:
        if stale not in (new, old):
            delete_path(spark, stale)
    if final != table:
        delete_path(spark, before)
    write_lines(spark, f"{root}/{final.rpartition('.')[2]}{LOCATION_SUFFIX}", [new, old] if old else [new])


def recover_swap(spark: SparkSession, table: str) -> bool:
    """Finish a swap that stopped after the drop: the new version exists but
    the table name does not."""
    staged = _staged_name(table)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(staged):
        new = _location(spark, staged)
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        _note_location(spark, table, table, new, None)
        return True
    return False


def swap_rewrite(spark: SparkSession, table: str, df: DataFrame, new_name: str | None = None) -> str:
    """Write a new version of ``table`` from ``df`` and swap it in. A query reads
    either version, never a mix."""
    staged, _ = write_version(spark, table, df)
    return swap_in(spark, table, staged, new_name)
