"""Tables under one switch: immutable layers, and a manifest that names the layers of every table.

A writer puts new layers beside the old ones and then commits a manifest with the next version, which is one rename of one small file. A
reader takes the highest manifest and reads what it names, so it sees all tables as of one commit, whatever is being written. Layers
are deleted when no manifest of the last `keep` versions names them.

What a writer has begun is noted in a journal before it is written. An attempt that fails before its commit leaves layers that no manifest names;
the next attempt finds them in the journal and deletes them. There is one writer at a time: a second commit of a version is an error.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimweave.sinks.folders import delete, names, put_text, read_text

KEEP = 2


@dataclass(frozen=True)
class Layer:
    """A folder of rows of one table, with whatever its owner notes about it."""

    path: str  # from the store's root
    facts: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, tuple[Layer, ...]]
    facts: dict = field(default_factory=dict)

    def paths(self) -> set[str]:
        return {layer.path for layers in self.tables.values() for layer in layers}

    def with_table(self, table: str, layers: list[Layer]) -> Manifest:
        return replace(self, tables={**self.tables, table: tuple(layers)})


def _unnamed(written, named: set[str]) -> list[str]:
    """Written folders that are no layer and hold none."""
    return [w for w in written if not any(n == w or n.startswith(f"{w}/") for n in named)]


class Snapshots:
    """Manifests and journal of a store, or of a branch: a line of versions of its own over the same store."""

    def __init__(self, spark: SparkSession, root: str, branch: str | None = None):
        self.spark, self.root, self.branch = spark, root.rstrip("/"), branch
        self.home = f"{self.root}/branches/{branch}" if branch else self.root
        self.journal = f"{self.home}/journal.json"

    # -- reading

    def _manifest(self, version: int) -> str:
        return f"{self.home}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in names(self.spark, f"{self.home}/manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def at(self, version: int) -> Manifest:
        known = json.loads(read_text(self.spark, self._manifest(version)))
        tables = {t: tuple(Layer(**layer) for layer in layers) for t, layers in known["tables"].items()}
        return Manifest(version, tables, known["facts"])

    def latest(self) -> Manifest | None:
        found = self.versions()
        return self.at(found[-1]) if found else None

    def read(self, layers: tuple[Layer, ...], schema: StructType) -> DataFrame:
        """The rows of some layers. The schema is given because there may be none."""
        if not layers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{layer.path}" for layer in layers])

    # -- writing

    def begin(self, work: dict) -> None:
        """Note a piece of work, and clear away what an attempt before it has left."""
        left = json.loads(read_text(self.spark, self.journal) or "{}")
        if left:
            now = self.latest()
            for path in _unnamed(left["layers"], now.paths() if now else set()):
                delete(self.spark, f"{self.root}/{path}")
        put_text(self.spark, self.journal, json.dumps({"work": work, "layers": []}), replace=True)

    def unfinished(self) -> dict | None:
        """The work begun and not committed, if any."""
        left = read_text(self.spark, self.journal)
        return json.loads(left)["work"] if left else None

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None, **facts) -> Layer:
        """Rows as a new layer, or as a folder of layers by the given columns, noted in the journal first. Readers don't see it before a commit."""
        noted = json.loads(read_text(self.spark, self.journal) or '{"work": {}, "layers": []}')
        path = f"data/{table}-{uuid.uuid4().hex}"
        noted["layers"].append(path)
        put_text(self.spark, self.journal, json.dumps(noted), replace=True)
        df.write.partitionBy(*(partition_by or [])).parquet(f"{self.root}/{path}")
        return Layer(path, facts)

    def commit(self, manifest: Manifest, keep: int = KEEP) -> Manifest:
        """Make a manifest the store's next version; then close the journal and delete what only older versions name."""
        now = self.latest()
        done = replace(manifest, version=now.version + 1 if now else 0)
        text = {"tables": {t: [asdict(layer) for layer in layers] for t, layers in done.tables.items()}, "facts": done.facts}
        put_text(self.spark, self._manifest(done.version), json.dumps(text))
        noted = json.loads(read_text(self.spark, self.journal) or '{"layers": []}')["layers"]
        for path in _unnamed(noted, done.paths()):  # a step on the way, such as a layer that was merged at once
            delete(self.spark, f"{self.root}/{path}")
        delete(self.spark, self.journal)
        self.retire(keep)
        return done

    def retire(self, keep: int = KEEP) -> None:
        found = self.versions()
        needed = set().union(*[self.at(v).paths() for v in found[-keep:]]) if found else set()
        for version in found[:-keep]:
            for path in self.at(version).paths() - needed:
                delete(self.spark, f"{self.root}/{path}")
            delete(self.spark, self._manifest(version))

    # -- branches

    def branch_off(self, name: str | None = None) -> Snapshots:
        """A new, empty line of versions; what unfinished branches before it have left is deleted."""
        for old in names(self.spark, f"{self.root}/branches"):
            Snapshots(self.spark, self.root, old).discard()
        return Snapshots(self.spark, self.root, name or uuid.uuid4().hex)

    def adopt(self, branch: Snapshots, facts: dict | None = None) -> Manifest:
        """Put a branch's latest state in the place of this line's, in one commit."""
        state = branch.latest()
        if state is None:
            raise ValueError(f"nothing was committed to {branch.home}")
        done = self.commit(replace(state, facts={**state.facts, **(facts or {})}))
        delete(self.spark, branch.home)
        return done

    def discard(self) -> None:
        """Delete a branch and its layers, unless the main line names them."""
        main = Snapshots(self.spark, self.root)
        needed = set().union(*[main.at(v).paths() for v in main.versions()])
        left = json.loads(read_text(self.spark, self.journal) or '{"layers": []}')["layers"]
        own = set(left).union(*[self.at(v).paths() for v in self.versions()])
        for path in _unnamed(own, needed):
            delete(self.spark, f"{self.root}/{path}")
        delete(self.spark, self.home)
