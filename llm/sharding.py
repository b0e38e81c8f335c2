"""Placement of documents in a tree of regions, racks and shards by weighted hash draws.

At each level a document draws a number for every child, -ln(u) / weight with u hashed from the document's key and the
child's name, and descends into the child with the least. A child's share is then proportional to its weight, and if
weights change, only documents that enter or leave a changed child at some level move: a change below
one region moves nothing between the others.

A shard that joins comes as a region of its own (`grown`). So the new region wins some documents, which can only
land on the new shard, and all other draws stay as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

ROWS_PER_GROUP = 100_000


@dataclass(frozen=True)
class Tree:
    """regions: of racks, of (shard number, weight). A node's weight is the sum of its shards' weights."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)


def tree(regions: int = 4, racks: int = 5, shards: int = 2) -> Tree:
    """An even tree with shards numbered from 0; 40 shards by default."""
    number = lambda r, k, s: (r * racks + k) * shards + s
    return Tree(tuple(tuple(tuple((number(r, k, s), 1.0) for s in range(shards)) for k in range(racks)) for r in range(regions)))


def grown(t: Tree, weight: float = 1.0) -> Tree:
    """t with one more shard, in a new region."""
    return Tree((*t.regions, (((t.n_shards, weight),),)))


def _draw(key: Column, children: list[tuple[str, float]]) -> Column:
    """Index of the child with the least draw; ties, which hashes of 53 bits all but exclude, go to the first."""
    if len(children) == 1:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.lit(float(w)).alias("w")) for i, (name, w) in enumerate(children) if w > 0])

    def drawn(child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / child["w"]).alias("draw"), child["i"].alias("i"))

    return F.array_min(F.transform(table, drawn))["i"]


def shard_of(key: Column, t: Tree) -> Column:
    """The shard of a key. A null key draws like any other constant."""
    key = F.coalesce(key.cast("string"), F.lit("\u0000"))
    rack_weight = lambda rack: sum(w for _, w in rack)
    picked = []
    for r, region in enumerate(t.regions):
        leaves = []
        for k, rack in enumerate(region):
            index = _draw(key, [(f"shard {s}", w) for s, w in rack])
            leaves.append(F.element_at(F.array(*[F.lit(s) for s, _ in rack]), index + 1))
        picked.append(_choose(_draw(key, [(f"rack {r}.{k}", rack_weight(rack)) for k, rack in enumerate(region)]), leaves))
    names = [(f"region {r}", sum(map(rack_weight, region))) for r, region in enumerate(t.regions)]
    return _choose(_draw(key, names), picked).cast("int")


def _choose(index: Column, values: list[Column]) -> Column:
    """The value at index; the others are not computed. The index is drawn once, as a one-element array's item."""
    if len(values) == 1:
        return values[0]

    def cases(i: Column) -> Column:
        out = F.when(i == 0, values[0])
        for k, v in enumerate(values[1:], 1):
            out = out.when(i == k, v)
        return out

    return F.transform(F.array(index), cases)[0]


def assign(docs: DataFrame, t: Tree | None = None, doc_id: str = "doc_id", text: str = "text", rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 16; a null text has no bytes. The shard depends on doc_id and the tree alone, so
    equal ids share a shard. slot numbers a shard's rows without gaps, in groups of ids by hash: rows are
    ranked in their group, and groups are offset by the sizes of those before, so no task sorts a whole shard.
    Rows that agree in id, size and checksum are interchangeable. Texts of any length are read whole, for size and checksum. An empty
    table gives no rows. Other columns of docs are not read.
    """
    t = t or tree()
    key, body = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    placed = stored(
        docs.select(
            key.alias("doc_id"),
            (F.octet_length(body) + 16).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(key, t).alias("shard"),
            shard_of(key, grown(t)).alias("grown_shard"),
        ),
        "placed",
    )
    # Rows with one id may be many; their checksums spread them.
    groups = max(4, -(-placed.count() // (t.n_shards * rows_per_group)))
    placed = placed.withColumn("__group", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(groups)))
    sizes = placed.groupBy("shard", "__group").agg(F.count("*").alias("__n"))
    before = sizes.alias("a").join(sizes.alias("b"), (F.col("a.shard") == F.col("b.shard")) & (F.col("b.__group") < F.col("a.__group")), "left")
    offsets = before.groupBy("a.shard", "a.__group").agg(F.coalesce(F.sum("b.__n"), F.lit(0)).alias("__before"))
    ranked = placed.selectExpr("*", "row_number() OVER (PARTITION BY shard, __group ORDER BY doc_id, size, text_crc32) - 1 AS __rank")
    return ranked.join(offsets, ["shard", "__group"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("__before") + F.col("__rank")).alias("slot"), "grown_shard"
    )
