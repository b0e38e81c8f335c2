"""A table in key ranges, so that an upsert rewrites the ranges its batch touches and leaves all other files alone.

The table is a line of snapshots whose layers are pieces: disjoint ranges of the key, in order, each with its least and greatest key and its number of
rows in the manifest. A batch finds its pieces by their least keys; those are merged with it, written anew and put in place of the
old ones by one commit. Readers see the table before or after it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from claimweave.operators.ranges import place_of
from claimweave.operators.sets import upsert
from claimweave.sinks.snapshots import Layer, Manifest, Snapshots

ROWS_PER_PIECE = 1_000_000
#: A table has about so many pieces at most: beyond, pieces hold more rows, as manifest, listings and files would grow with the table.
MOST_PIECES = 512


class RangedTable:
    def __init__(self, spark: SparkSession, root: str, rows_per_piece: int = ROWS_PER_PIECE):
        self.spark, self.store, self.rows_per_piece = spark, Snapshots(spark, root), rows_per_piece

    # -- reading

    def _now(self) -> Manifest:
        now = self.store.latest()
        if now is None:
            raise ValueError(f"{self.store.root} holds no table")
        return now

    def _schema(self, now: Manifest) -> StructType:
        return StructType.fromJson(now.facts["schema"])

    def read(self) -> DataFrame:
        now = self._now()
        return self.store.read(now.tables["pieces"], self._schema(now))

    def pieces(self) -> list[dict]:
        """Path, bounds and number of rows of each piece, in key order."""
        return [{"path": layer.path, **layer.facts} for layer in self._now().tables["pieces"]]

    def page(self, number: int, size: int) -> DataFrame:
        """One page in key order, from 0. Only the pieces it lies in are read, however deep it is: their numbers of rows are known.

        Rows of equal keys are ordered by their other columns; they lie in one piece.
        """
        now, first, before, found = self._now(), number * size, 0, []
        skip = 0
        for piece in now.tables["pieces"]:
            rows = piece.facts["rows"]
            if before < first + size and before + rows > first:
                if not found:
                    skip = first - before
                found.append(piece)
            before += rows
        keys, schema = now.facts["keys"], self._schema(now)
        order = [*keys, *[c for c in schema.fieldNames() if c not in keys]]
        return self.store.read(tuple(found), schema).orderBy(*order).offset(max(skip, 0)).limit(size)

    # -- writing

    def create(self, df: DataFrame, keys: list[str]) -> None:
        """Lay a table out by its keys, in place of what was there before. Rows with a null in the key come first."""
        now = self.store.latest()
        self.store.begin({"create": True})
        rows = df.count()
        pieces = self._write(df.withColumn("_piece", F.lit(0)), keys, rows, rows)
        self.store.commit(Manifest(now.version if now else 0, {"pieces": tuple(p for _, p in pieces)}, {"keys": keys, "schema": df.schema.jsonValue()}))

    def upsert(self, batch: DataFrame, latest: str | None = None) -> int:
        """Upsert a batch (see ``sets.upsert``); returns how many pieces were rewritten.

        The batch is read twice: for the pieces it touches, keys only, and to merge it. An empty batch changes nothing.
        """
        now = self._now()
        keys, schema, old = now.facts["keys"], self._schema(now), now.tables["pieces"]
        placed = batch.withColumn("_piece", self._piece_of(keys, schema, old))
        counts = {r[0]: r[1] for r in placed.groupBy("_piece").count().collect()}  # one row per piece at most
        touched = set(counts)
        if not touched:
            return 0
        self.store.begin({"upsert": sorted(touched)})
        before = self.store.read(tuple(old[i] for i in sorted(touched) if i < len(old)), schema)
        merged = upsert(before, batch, keys, latest)
        most = sum(counts.values()) + sum(old[i].facts["rows"] for i in touched if i < len(old))
        whole = sum(counts.values()) + sum(p.facts["rows"] for p in old)
        new = self._write(merged.withColumn("_piece", self._piece_of(keys, schema, old)), keys, most, whole)
        kept = [((i,), p) for i, p in enumerate(old) if i not in touched]
        pieces = [p for _, p in sorted([*kept, *new], key=lambda p: p[0])]
        self.store.commit(Manifest(now.version, {"pieces": tuple(pieces)}, now.facts))
        return len(touched)

    def _piece_of(self, keys: list[str], schema: StructType, pieces: tuple[Layer, ...]) -> Column:
        """Number of the piece for a key: the last one that begins at or before it, or the first one."""
        if len(pieces) < 2:
            return F.lit(0)
        kind = StructType([schema[k] for k in keys])
        starts = [dict(zip(keys, p.facts["low"], strict=True)) for p in pieces[1:]]
        return place_of(F.struct(*keys), starts, lambda rows: F.from_json(F.lit(json.dumps(rows)), ArrayType(kind)))

    def _write(self, df: DataFrame, keys: list[str], rows: int, whole: int) -> list[tuple[tuple[int, ...], Layer]]:
        """At most so many rows with their old piece (_piece) as new pieces, each with its place: the old piece's, and one within it.

        ``whole`` is the number of rows of the table, by which pieces grow.
        """
        parts = max(1, -(-rows // max(self.rows_per_piece, -(-whole // MOST_PIECES))))
        ordered = df.repartitionByRange(parts, "_piece", *keys).sortWithinPartitions("_piece", *keys)
        written = self.store.write(ordered.withColumn("_part", F.spark_partition_id()), "pieces", partition_by=["_piece", "_part"])
        own = F.struct(*keys)
        schema = StructType([*[f for f in df.schema if f.name != "_piece"], StructField("_piece", IntegerType()), StructField("_part", IntegerType())])
        saved = self.spark.read.schema(schema).parquet(f"{self.store.root}/{written.path}")
        found = saved.groupBy("_piece", "_part").agg(F.to_json(F.min(own)).alias("low"), F.to_json(F.max(own)).alias("high"), F.count("*").alias("rows"))
        layers = []
        for r in sorted(found.collect(), key=lambda r: (r["_piece"], r["_part"])):  # a row per piece
            low, high = (json.loads(r[c]) for c in ("low", "high"))
            facts = {"low": [low.get(k) for k in keys], "high": [high.get(k) for k in keys], "rows": r["rows"]}
            layers.append(((r["_piece"], r["_part"]), Layer(f"{written.path}/_piece={r['_piece']}/_part={r['_part']}", facts)))
        return layers
