"""Operator 7: near-duplicate vectors by an epsilon grid order join.

Unit vectors of cosine >= c lie within epsilon = sqrt(2 - 2c) of each other, and a
projection never moves them further apart. Equal vectors of a label are one class
first. Classes are projected on leading principal directions, sorted by their grid
cells of width epsilon (first direction first) and cut into blocks of consecutive
vectors. Pairs of blocks whose boxes lie within epsilon are joined: intervals of
the two sequences are halved again and again, skipping those whose boxes are
provably further apart, and what remains is compared exactly. A block pair gives
link counts and a spanning forest of its links, never the list of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import cut, hashed_share, read, ship
from periodica.llm.components import Forest, components


@dataclass(frozen=True)
class GridRules:
    cosine: float = 0.98
    directions: int = 8     # leading principal directions
    block: int = 1024       # vectors
    leaf: int = 128         # vectors of an interval that is compared at once
    sample: int = 8192      # vectors that the directions are fitted on; they only steer speed

    @property
    def epsilon(self) -> float:
        return float(np.sqrt(2.0 - 2.0 * self.cosine)) + 1e-6


def directions(classes: DataFrame, rules: GridRules) -> np.ndarray:
    """Principal directions of a sample of bounded size, chosen by hash, one per column."""
    some = classes.filter(hashed_share(F.col("cid"), rules.sample, classes.count()))
    rows = some.orderBy("cid").select("vector").collect()
    dims = max((len(r[0]) for r in rows), default=1)
    x = np.array([r[0] for r in rows if len(r[0]) == dims], dtype=np.float64).reshape(-1, dims)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    _, axes = np.linalg.eigh(np.cov(x, rowvar=False).reshape(dims, dims) if len(x) > 1 else np.eye(dims))
    return axes[:, ::-1][:, :rules.directions]


def _project(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the directions; vectors of another length get none (all 0)."""
    if x.shape[1] != axes.shape[0]:
        return np.zeros((len(x), axes.shape[1]))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes


def _matrix(col: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_pylist()])


def _boxes_apart(lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> float:
    gap = np.maximum(0.0, np.maximum(lo - hi2, lo2 - hi))
    return float(np.sqrt((gap * gap).sum()))


def join_blocks(x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, same: bool,
                rules: GridRules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of links between two blocks; in a block itself only i < j."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:
            continue
        if _boxes_apart(px[a:b].min(0), px[a:b].max(0), py[c:d].min(0), py[c:d].max(0)) > rules.epsilon:
            continue
        if b - a <= rules.leaf and d - c <= rules.leaf:
            cos = (x[a:b] @ y[c:d].T) / (nx[a:b, None] * ny[None, c:d])
            i, j = np.nonzero(cos >= rules.cosine)
            i, j = i + a, j + c
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]


def _blocks(classes: DataFrame, axes: np.ndarray, rules: GridRules) -> DataFrame:
    """One row per block: its classes in epsilon grid order, their vectors and their box."""
    k = axes.shape[1]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = b.column("vector").to_pylist()
                out = np.zeros((len(rows), k))
                ok = np.array([len(r) == axes.shape[0] for r in rows])
                if ok.any():
                    out[ok] = _project(np.array([r for r, o in zip(rows, ok) if o], dtype=np.float64), axes)
                cell = np.floor(out / rules.epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    b.columns + [pa.array([c.tolist() for c in cell], pa.list_(pa.int32()))],
                    names=b.schema.names + ["cell"])

    def chop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def block() -> pa.RecordBatch:
            x = np.array([r["vector"] for r in held], dtype=np.float64)
            p = _project(x, axes)
            row = {"block": held[0]["cid"], "label": held[0]["label"], "dims": x.shape[1],
                   "cids": np.array([r["cid"] for r in held], np.int64).tobytes(),
                   "sizes": np.array([r["size"] for r in held], np.int64).tobytes(),
                   "x": x.tobytes(), "lo": p.min(0).tolist(), "hi": p.max(0).tolist()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("block", pa.int64()), ("label", pa.int32()), ("dims", pa.int32()), ("cids", pa.binary()),
                ("sizes", pa.binary()), ("x", pa.binary()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]))
        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) == rules.block or held[0]["label"] != r["label"] or len(held[0]["vector"]) != len(r["vector"])):
                    yield block()
                    held = []
                held.append(r)
        if held:
            yield block()
    order = [F.col("label"), F.size("vector"), *[F.get("cell", F.lit(i)) for i in range(k)], F.col("cid")]
    return (classes.mapInArrow(cells, "cid long, label int, size long, vector array<double>, cell array<int>")
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select("cid", "label", "size", "vector")
            .mapInArrow(chop, "block long, label int, dims int, cids binary, sizes binary, x binary, "
                              "lo array<double>, hi array<double>"))


def _near_blocks(blocks: DataFrame, rules: GridRules) -> DataFrame:
    """Pairs (a <= b) of blocks of one label and length whose boxes lie within epsilon.

    Boxes meet by equi-join on the grid cells of the first two directions that they
    cover, one side with its neighbour cells."""
    e = F.lit(rules.epsilon)

    def covered(i: int, more: int):
        at = F.lit(i)
        return F.sequence(F.floor(F.get("lo", at) / e) - more, F.floor(F.get("hi", at) / e) + more)
    two = F.size("lo") > 1

    def spread(more: int) -> DataFrame:
        d = blocks.select("block", "label", "dims", "lo", "hi", F.explode(covered(0, more)).alias("c0"))
        return d.select("*", F.explode(F.when(two, covered(1, more)).otherwise(F.array(F.lit(0).cast("long")))).alias("c1"))
    b = spread(1).select(F.col("block").alias("b"), "label", "dims", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), "c0", "c1")
    gap = F.zip_with(F.arrays_zip("lo", "hi"), F.arrays_zip("lo2", "hi2"), lambda p, q: F.greatest(
        F.lit(0.0), p["lo"] - q["hi2"], q["lo2"] - p["hi"]))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    return (spread(0).withColumnRenamed("block", "a").join(b, ["label", "dims", "c0", "c1"])
            .filter(F.col("a") <= F.col("b")).filter(apart <= rules.epsilon ** 2).select("a", "b").distinct())


def _links(blocks: DataFrame, axes: np.ndarray, rules: GridRules) -> DataFrame:
    """Rows (cid, other, n): n more links of the class (other null), or a forest edge (n 0)."""
    cols = ["cids", "sizes", "x", "dims"]
    left = blocks.select(F.col("block").alias("a"), *cols)
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(c + "2") for c in cols])
    pairs = _near_blocks(blocks, rules)
    work = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (row for b in batches for i in range(b.num_rows) for row in b.slice(i, 1).to_pylist()):
            ids, ids2 = np.frombuffer(r["cids"], np.int64), np.frombuffer(r["cids2"], np.int64)
            size, size2 = np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["sizes2"], np.int64)
            x = np.frombuffer(r["x"]).reshape(-1, r["dims"])
            y = np.frombuffer(r["x2"]).reshape(-1, r["dims2"])
            same, shift = r["a"] == r["b"], 0 if r["a"] == r["b"] else len(ids)
            n, forest = np.zeros(shift + len(ids2), np.int64), Forest(shift + len(ids2))
            every = ids if same else np.concatenate([ids, ids2])
            edges: list[tuple[int, int]] = []
            for i, j in join_blocks(x, _project(x, axes), y, _project(y, axes), same, rules):
                np.add.at(n, i, size2[j])
                np.add.at(n, j + shift, size[i])
                edges += [(p, q) for p, q in zip(i.tolist(), (j + shift).tolist()) if forest.union(p, q)]
            hit = np.flatnonzero(n)
            p = np.array(edges, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([every[hit], every[p[:, 0]]])),
                 pa.array([None] * len(hit) + every[p[:, 1]].tolist(), pa.int64()),
                 pa.array(np.concatenate([n[hit], np.zeros(len(p), np.int64)]))], names=["cid", "other", "n"])
    return work.repartition(F.col("a"), F.col("b")).mapInArrow(run, "cid long, other long, n long")


def near_vectors(vectors: DataFrame, rules: GridRules = GridRules(), vec_id: str = "vec_id",
                 embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Vectors with a null label, null, empty, zero or with null or non-finite
    components link with nothing, as do vectors of different lengths. Equal
    vectors of a label link with each other; equal rows are separate vectors. A
    null vec_id never names a component unless the whole component is null.
    Further columns are ignored; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    v = F.col(embedding)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.coalesce(F.col(label).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("int").alias("label"),
                          v.cast("array<double>").alias("vector"), ok.alias("ok"))
    rows = rows.withColumn("cid", F.when(F.col("ok"), F.xxhash64("label", "vector")))
    classes = cut(rows.filter("ok").groupBy("cid").agg(
        F.first("label").alias("label"), F.count("*").alias("size"), F.min("vec_id").alias("low"),
        F.first("vector").alias("vector")))
    axes = directions(classes, rules)
    blocks = cut(_blocks(classes.select("cid", "label", "size", "vector"), axes, rules))
    found = cut(_links(blocks, axes, rules))
    roots = components(found.filter(F.col("other").isNotNull()).select(F.col("cid").alias("a"), F.col("other").alias("b")))
    more = found.filter(F.col("other").isNull()).groupBy("cid").agg(F.sum("n").alias("more"))
    known = (classes.select("cid", "size", "low").join(more, "cid", "left")
             .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    lows = known.groupBy("root").agg(F.min("low").alias("component"))
    known = known.join(lows, "root").select(
        F.col("cid").alias("_c"), "component", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    return (rows.select("vec_id", "cid").join(known, F.col("cid") == F.col("_c"), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("_c").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op7_grid_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: links of cosine 0.98 within labels, and their components."""
    return near_vectors(read(spark, sf_dir, "embeddings"))
