"""Text-log sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LOG_GLOB = "*.log"
# More lines than a usual file split holds: only unsplittable files are cut by this.
ROWS_PER_BLOCK = 1 << 21


def located_lines(raw: DataFrame) -> DataFrame:
    """Lines with file, block and order, from a text scan that kept its file metadata.

    A scan task reads its lines in file order, so a running id orders the lines of a split. A
    compressed file is always one split; blocks have a largest number of rows for its sake.
    """
    row_in_task = F.col("ord").bitwiseAND(F.lit((1 << 33) - 1))
    return raw.select(
        F.col("file_path").alias("file"), "file_block_start", F.monotonically_increasing_id().alias("ord"), "value"
    ).select(
        "file",
        F.struct("file_block_start", F.floor(row_in_task / ROWS_PER_BLOCK).alias("part")).alias("block"),
        "ord",
        F.col("value").alias("line"),
    )


def read_log_lines(spark: SparkSession, path: str, glob: str = LOG_GLOB, flat_folder: bool = False) -> DataFrame:
    """All lines of the log files of a folder, searched in depth unless it is flat, as the incremental load does."""
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", not flat_folder).text(path)
    return located_lines(raw.select("value", "_metadata.file_path", "_metadata.file_block_start"))


def list_files(spark: SparkSession, path: str, glob: str = LOG_GLOB) -> DataFrame:
    """Path, size and modification time of the files of a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", "modificationTime")
