"""Incremental and full load of log files.

A store holds three tables of layers under one manifest (`sinks.snapshots`): entries; partial values of all summaries; and loaded files. A load
adds one layer to each and commits once. Partial values are merged by size like a log-structured tree: as soon as FAN_IN layers
are of one level, they become one of the next. So a load writes what it brings, and a key is rewritten once per level, not once per load.
Summaries and statistics are read from the layers of one manifest, so they agree with each other and with the entries.

The manifest also holds what ties the store to its stream: the checkpoint, the stream's id and the last load. A stream repeats a load whose end its
checkpoint has not seen; the store skips it if it is committed, and else does it anew after clearing what the journal lists.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimweave.operators.logs import assemble_entries, hour_key, metric_key, stats_from_counts
from claimweave.schemas import LOG_ENTRY, contract
from claimweave.sinks.folders import names, read_text
from claimweave.sinks.snapshots import Layer, Manifest, Snapshots
from claimweave.sources.logs import LOG_GLOB, located_lines

#: So many layers of one level are merged to one of the next.
FAN_IN = 8

# Summary -> its keys. A gap never crosses a file and a file belongs to one load, so partial
# values (count, gap sum, gap count, gap maximum) of loads merge exactly.
SUMMARY_KEYS = {
    "hourly": ["date", "hour"],
    "user": ["username"],
    "ip": ["ip"],
    "level": ["log_level", "function"],
}
PARTIALS = contract(
    "date date, hour int, username string, ip string, log_level string, function string, "
    "n long, gap_sum double, gap_n long, gap_max double, summary string"
)

SUMMARIES = {
    "hourly": contract("date date, hour int, log_count long, avg_time_diff double, max_time_diff double"),
    "user": contract("username string, count long"),
    "ip": contract("ip string, count long"),
    "level": contract("log_level string, function string, count long"),
}


FILES = contract("file string, entries long, load_id long")


def partial_summaries(entries: DataFrame) -> DataFrame:
    """Partial values of all summaries, from one pass over the entries."""
    keys = [k for columns in SUMMARY_KEYS.values() for k in columns]
    summary = reduce(
        lambda case, s: case.when(F.grouping(SUMMARY_KEYS[s][0]) == 0, s), SUMMARY_KEYS, F.when(F.lit(False), "")
    )
    grouped = entries.withColumn("log_level", F.lower("log_level")).groupingSets(list(SUMMARY_KEYS.values()), *keys)
    return grouped.agg(
        F.count("*").alias("n"),
        F.sum("time_diff_seconds").alias("gap_sum"),
        F.count("time_diff_seconds").alias("gap_n"),
        F.max("time_diff_seconds").alias("gap_max"),
        summary.alias("summary"),
    )


def merged(partials: DataFrame) -> DataFrame:
    """Partial values with one row per key and summary."""
    keys = ["summary", *[k for columns in SUMMARY_KEYS.values() for k in columns]]
    sums = [F.sum(c).alias(c) for c in ("n", "gap_sum", "gap_n")]
    return partials.groupBy(*keys).agg(*sums, F.max("gap_max").alias("gap_max")).select(*PARTIALS.fieldNames())


def merged_summary(state: DataFrame, name: str) -> DataFrame:
    """One summary table from merged partial values."""
    own = state.where(F.col("summary") == name)
    if name != "hourly":
        return own.select(*SUMMARY_KEYS[name], F.col("n").alias("count"))
    mean = F.try_divide("gap_sum", "gap_n")
    return own.select(*SUMMARY_KEYS[name], F.col("n").alias("log_count"), mean.alias("avg_time_diff"), F.col("gap_max").alias("max_time_diff"))


# -- loading -----------------------------------------------------------------------------------------


def _stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a checkpoint keeps for its stream; None before the stream's first start."""
    known = read_text(spark, f"{checkpoint}/metadata")
    return json.loads(known)["id"] if known else None


def _last_done(spark: SparkSession, checkpoint: str) -> int:
    """The last load that the checkpoint has seen through; -1 for none."""
    return max((int(n) for n in names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _claim_store(store: Snapshots, checkpoint: str) -> None:
    """Tie store and checkpoint, or check that they belong together: loads under another checkpoint, or a lost one, would count files twice.

    The checkpoint may be one load behind: the store has committed a load whose end the checkpoint has not seen. A stream that has not
    finished any load, be it for want of files or for a failure, may go on in a store without loads.
    """
    spark, now = store.spark, store.latest()
    done = _last_done(spark, checkpoint)
    loaded = now.facts["load_id"] if now else -1
    if loaded < 0:
        if done >= 0:
            raise ValueError(f"the checkpoint {checkpoint} has loaded files, but not into {store.root}; use full_reload with a new one")
        if now is None or now.facts["checkpoint"] != checkpoint:
            store.commit(Manifest(0, {"entries": (), "partials": (), "files": ()}, {"checkpoint": checkpoint, "stream": None, "load_id": -1}))
    elif now.facts["checkpoint"] != checkpoint or now.facts["stream"] != _stream_id(spark, checkpoint) or done not in (loaded, loaded - 1):
        raise ValueError(f"{store.root} was filled under the checkpoint {now.facts['checkpoint']}, up to load {loaded}; use that one, or full_reload")


def _merge_levels(store: Snapshots, layers: list[Layer]) -> list[Layer]:
    """The layers of partial values after merging each level that is full."""
    level = 0
    while any(layer.facts["level"] >= level for layer in layers):
        full = [layer for layer in layers if layer.facts["level"] == level]
        if len(full) >= FAN_IN:
            one = store.write(merged(store.read(tuple(full), PARTIALS)), "partials", level=level + 1)
            layers = [layer for layer in layers if layer.facts["level"] != level] + [one]
        level += 1
    return layers


def _load(lines: DataFrame, store: Snapshots, load_id: int, stream: str | None = None) -> None:
    """Add one load with one commit. Its own layers are all that it writes, but for merges."""
    now = store.latest()
    if load_id <= now.facts["load_id"]:
        return  # committed; only the checkpoint had not seen it
    if load_id != now.facts["load_id"] + 1:
        raise ValueError(f"{store.root} holds loads up to {now.facts['load_id']}, and load {load_id} does not follow")
    store.begin({"load_id": load_id, "stream": stream})
    entries = store.write(assemble_entries(located_lines(lines)), "entries", load_id=load_id)
    saved = store.read((entries,), LOG_ENTRY)
    partials = store.write(partial_summaries(saved), "partials", level=0)
    files = saved.groupBy("file").agg(F.count("*").alias("entries")).withColumn("load_id", F.lit(load_id).cast("long"))
    tables = {
        "entries": (*now.tables["entries"], entries),
        "partials": tuple(_merge_levels(store, [*now.tables["partials"], partials])),
        "files": (*now.tables["files"], store.write(files, "files", load_id=load_id)),
    }
    store.commit(Manifest(now.version, tables, {**now.facts, "load_id": load_id, "stream": stream}))


def _run(spark: SparkSession, source: str, store: Snapshots, checkpoint: str, glob: str, flat_folder: bool, files_per_load: int | None) -> None:
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    reader = reader.option("fileNameOnly", flat_folder).option("recursiveFileLookup", not flat_folder)
    if files_per_load:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    raw = reader.load(source).select("value", "_metadata.file_path", "_metadata.file_block_start")
    run = raw.writeStream.foreachBatch(lambda lines, load_id: _load(lines, store, load_id, _stream_id(spark, checkpoint)))
    run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_new_logs(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    glob: str = LOG_GLOB,
    flat_folder: bool = False,
    files_per_load: int | None = None,
) -> None:
    """Load the files the checkpoint has not seen.

    Work and bytes written grow with the new files, not with the history. Folders are searched in depth and a file is known by
    its full path. In a ``flat_folder`` only the folder itself is searched and a file is known by its name. A store is only
    ever added to: under another checkpoint than its own it is an error. A folder without files makes an empty store. A load that failed, at
    whatever step, is done by the next call.
    """
    checkpoint, snapshots = checkpoint.rstrip("/"), Snapshots(spark, store)
    _claim_store(snapshots, checkpoint)
    _run(spark, source, snapshots, checkpoint, glob, flat_folder, files_per_load)


def full_reload(
    spark: SparkSession,
    source: str,
    store: str,
    new_checkpoint: str,
    glob: str = LOG_GLOB,
    flat_folder: bool = False,
    files_per_load: int | None = None,
    allow_empty: bool = False,
) -> None:
    """Replace the store by all files of the folder; later increments go on from the new checkpoint.

    The job is the incremental one, on a branch of the store, which takes the place of the old state in one commit. A folder
    without any file is refused unless ``allow_empty``: it is more often a wrong path than a wish.
    """
    checkpoint, snapshots = new_checkpoint.rstrip("/"), Snapshots(spark, store)
    branch = snapshots.branch_off()
    try:
        _claim_store(branch, checkpoint)
        _run(spark, source, branch, checkpoint, glob, flat_folder, files_per_load)
        if branch.latest().facts["load_id"] < 0 and not allow_empty:
            raise ValueError(f"no file {glob} in {source}; {store} stays as it is")
        snapshots.adopt(branch)
    finally:
        branch.discard()


# -- reading -----------------------------------------------------------------------------------------


class LogSnapshot:
    """All tables of a store as of one commit."""

    def __init__(self, spark: SparkSession, store: str):
        self.store = Snapshots(spark, store)
        self.manifest = self.store.latest()
        if self.manifest is None:
            raise ValueError(f"{store} holds no tables")

    def entries(self) -> DataFrame:
        return self.store.read(self.manifest.tables["entries"], LOG_ENTRY)

    def files(self) -> DataFrame:
        """Files with entries: their path, number of entries and load."""
        return self.store.read(self.manifest.tables["files"], FILES)

    def _partials(self) -> DataFrame:
        return self.store.read(self.manifest.tables["partials"], PARTIALS)

    def summary(self, name: str) -> DataFrame:
        state = merged(self._partials().where(F.col("summary") == name))
        return merged_summary(state, name).select(*SUMMARIES[name].fieldNames())

    def stats(self) -> DataFrame:
        """The statistics table over all loads, from the partial values instead of the entries."""
        one = {"hourly": [("hour", hour_key())], "user": [("top_usernames", F.col("username"))], "ip": [("top_ips", F.col("ip"))]}
        one["level"] = [("log_levels", F.col("log_level")), ("top_functions", F.col("function"))]

        def pick(case: Column, name: str) -> Column:
            return case.when(F.col("summary") == name, F.array(*[metric_key(m, key) for m, key in one[name]]))

        pairs = self._partials().select("n", F.explode(reduce(pick, one, F)).alias("p"))
        return stats_from_counts(pairs.groupBy("p.metric", "p.key").agg(F.sum("n").alias("n")))


def read_entries(spark: SparkSession, store: str) -> DataFrame:
    return LogSnapshot(spark, store).entries()


def read_summary(spark: SparkSession, store: str, name: str) -> DataFrame:
    return LogSnapshot(spark, store).summary(name)


def read_stats(spark: SparkSession, store: str) -> DataFrame:
    return LogSnapshot(spark, store).stats()
