"""Operator 1: sharding by a hierarchical weighted hash tree.

A topology is a list of regions, a region a list of racks, a rack a list of
``(shard, weight)``. A document descends region, rack and shard levels; at each
level every child draws ``-ln(u) / weight`` with ``u`` a hash of the key, the
level and the child's name, and the smallest draw wins. A child's draw depends
on nothing but the key, its name and its weight, so a changed weight moves keys
only into or out of that child: movement stays inside subtrees whose weight
changed, and a new region takes keys into itself alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import chunks_for, cut, read, running_start

UNIT = float(2 ** 53)


@dataclass(frozen=True)
class Topology:
    """regions -> racks -> ((shard, weight), ...); names are positions, so order matters."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    def grow(self, weight: float = 1.0) -> "Topology":
        """One more shard, alone in a region of its own: no old subtree changes its weight."""
        shards = [s for reg in self.regions for rack in reg for s, _ in rack]
        return Topology(self.regions + ((((max(shards, default=-1) + 1, weight),),),))


def topology(shards: int, per_rack: int = 4, racks: int = 2, base: int = 16) -> Topology:
    """Shards of weight 1: the first ``base`` fill regions, each later one is a region of its own."""
    first = min(shards, base)
    rack_list = [tuple((s, 1.0) for s in range(a, min(a + per_rack, first))) for a in range(0, first, per_rack)]
    t = Topology(tuple(tuple(rack_list[a:a + racks]) for a in range(0, len(rack_list), racks)))
    for _ in range(shards - first):
        t = t.grow()
    return t


def _winner(key: Column, level: str, path: Column, children: Column) -> Column:
    """Name of the child with the smallest weighted draw; children of weight 0 never win."""
    def draw(c: Column) -> Column:
        h = F.xxhash64(key, F.lit(level), path, c["name"])
        u = (F.pmod(h, F.lit(2 ** 53)).cast("double") + 0.5) / UNIT
        return F.struct((-F.log(u) / c["weight"]).alias("draw"), c["name"].alias("name"))
    alive = F.filter(children, lambda c: c["weight"] > 0)
    return F.array_min(F.transform(alive, draw))["name"]


def _child(name: int, weight: float) -> Column:
    return F.struct(F.lit(name).cast("int").alias("name"), F.lit(float(weight)).alias("weight"))


def _total(rack) -> float:
    return sum(w for _, w in rack)


def shard_column(key: Column, topo: Topology) -> Column:
    """Shard of a key: three weighted draws, O(fan-out) work per level."""
    regions = F.array(*[_child(i, sum(map(_total, reg))) for i, reg in enumerate(topo.regions)])
    racks = F.array(*[F.array(*[_child(j, _total(rack)) for j, rack in enumerate(reg)])
                      for reg in topo.regions])
    shards = F.array(*[F.array(*[F.array(*[_child(s, w) for s, w in rack]) for rack in reg])
                       for reg in topo.regions])

    def in_region(r: Column) -> Column:
        def in_rack(k: Column) -> Column:
            return _winner(key, "shard", r * 4096 + k, F.get(F.get(shards, r), k))
        rack = _winner(key, "rack", r, F.get(racks, r))
        return F.get(F.transform(F.array(rack), in_rack), F.lit(0))
    region = _winner(key, "region", F.lit(0), regions)
    return F.get(F.transform(F.array(region), in_region), F.lit(0))


def shard_documents(docs: DataFrame, topo: Topology, grown: Topology | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and, with ``grown``, the shard under that topology.

    Law ``key``: the key column and the topology decide the shard. A null key is
    a key like any other; a null text has size 1 and the CRC of no bytes; equal
    rows get separate slots; an empty table gives no rows; further columns are
    ignored. Slots run gapless from 0 in each shard, in hash order of the rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), shard_column(F.col(key), topo).alias("shard"),
        (shard_column(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.lit(1).cast("long").alias("_one"))
    rows = cut(rows)
    out = running_start(rows, ["shard"], ["doc_id", "text_crc32", "size"], "_one",
                        chunks_for(rows.count()), "slot")
    return out.drop("_one")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15 under the law ``key``, and with one more shard."""
    topo = topology(16)
    return (shard_documents(read(spark, sf_dir, "documents"), topo, topo.grow())
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))
