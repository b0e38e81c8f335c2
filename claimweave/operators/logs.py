"""Log lines to entries, and summaries over entries.

Lines come as (file, block, ord, line). A block is a bounded stretch of one file: a
split of a text file, or a range of positions. All windows over lines are per block;
what crosses blocks is settled on one small row per block. So a single huge file is
spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimweave.functions import logtext
from claimweave.functions.scalars import strip
from claimweave.operators.ranges import pieces_for
from claimweave.schemas import LOG_ENTRY, conform

ROWS_PER_BLOCK = 65_536
#: Lines that one task sorts, when blocks are smaller.
ROWS_PER_PART = 1 << 18


def lines_from_table(df: DataFrame, file: str = "file", pos: str = "pos", line: str = "line",
                     rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Lines held in a table with a position per file; blocks are ranges of positions."""
    return df.select(
        F.coalesce(F.col(file), F.lit("")).alias("file"),
        F.coalesce(F.floor(F.col(pos) / rows_per_block), F.lit(-1)).alias("block"),
        F.col(pos).alias("ord"),
        F.col(line).alias("line"),
    )


def _with_message_parts(df: DataFrame) -> DataFrame:
    message, ts = F.col("message"), F.col("timestamp")
    return df.withColumns(
        {
            "function": logtext.function_name(message),
            "file_info": logtext.file_info(message),
            "clean_message": logtext.clean_message(message),
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "minute": F.minute(ts),
        }
    )


def header_entries(lines: DataFrame) -> DataFrame:
    """One row per header line, without continuation lines; needs no shuffle."""
    text = strip(F.col("line"))
    heads = lines.select("file", "block", "ord", text.alias("text")).where(logtext.matches(F.col("text"), logtext.HEADER))
    return _with_message_parts(heads.select("file", "block", "ord", *logtext.entry_fields(F.col("text"))))


def time_gaps(entries: DataFrame) -> DataFrame:
    """Adds the seconds to the next entry of the same file, in file order; null for the last one.

    Entries are shuffled once, by block. Each block settles all its entries but the last; first and last entries of the blocks, two rows a
    block, come from that same exchange and meet per file.
    """
    in_block, by_block = Window.partitionBy("file", "block").orderBy("ord"), Window.partitionBy("file").orderBy("block", "ord")
    marked = entries.withColumns(
        {
            "next_timestamp": F.lead("timestamp").over(in_block),
            "first_of_block": F.lag(F.lit(1)).over(in_block).isNull(),
            "last_of_block": F.lead(F.lit(1)).over(in_block).isNull(),
        }
    )
    edges = marked.where(F.col("first_of_block") | F.col("last_of_block"))
    last = edges.withColumn("next_timestamp", F.lead("timestamp").over(by_block)).where("last_of_block")
    gap = logtext.seconds_between(F.col("timestamp"), F.col("next_timestamp")).alias("time_diff_seconds")
    return marked.where(~F.col("last_of_block")).unionByName(last).select(*entries.columns, gap)


def _dealt(lines: DataFrame) -> DataFrame:
    """Stripped lines, marked where an entry begins and dealt by block: the one shuffle of lines, which all steps after it read.

    The number of parts grows with the lines (one job counts them), so a task sorts a bounded number, or one block. Every step
    uses all of these columns; with fewer, it would get a shuffle of its own.
    """
    text, rows = strip(F.col("line")), lines.count()
    at = F.coalesce(F.col("ord").cast("long"), F.lit(-(1 << 63)))
    marked = lines.select("file", "block", at.alias("ord"), text.alias("text"))
    marked = marked.withColumn("is_header", F.coalesce(logtext.matches(F.col("text"), logtext.HEADER), F.lit(False)))
    return marked.repartition(pieces_for(lines, rows, ROWS_PER_PART), "file", "block")


def _numbered(dealt: DataFrame) -> DataFrame:
    """Lines with their number in the block and the number of headers up to them (the piece). Of equal positions, headers come first."""
    in_block = Window.partitionBy("file", "block").orderBy("ord", F.desc("is_header"))
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dealt.withColumns(
        {
            "piece": F.sum(F.col("is_header").cast("long")).over(so_far),
            "line_no": F.row_number().over(in_block),
        }
    )


def _continuations() -> Column:
    """The continuation lines, in order, as an aggregate."""
    ordered = F.sort_array(F.collect_list(F.when(~F.col("is_header"), F.struct("line_no", "text"))))
    return F.transform(ordered, lambda x: x["text"])


def _pieces(numbered: DataFrame) -> DataFrame:
    """Headers with their continuation lines, as far as their own block holds them."""
    used = numbered.where((F.col("piece") > 0) & (F.col("text") != ""))
    pieces = used.groupBy("file", "block", "piece").agg(
        F.max(F.when(F.col("is_header"), F.col("text"))).alias("line"),
        F.min("line_no").alias("first_line"),
        _continuations().alias("more"),
    )
    return pieces.select("file", "block", "piece", "first_line", "more", *logtext.entry_fields(F.col("line")))


def _block_context(dealt: DataFrame) -> DataFrame:
    """Per block: lines before it, its first header, the next block's first entry, and the block whose last entry owns its leading lines.

    Rows hold no texts but one header's time. What headers give is one column, so all uses of this read the same,
    unless the caller drops columns of the entries.
    """
    header = lambda c: F.when(F.col("is_header"), c)
    stats = dealt.groupBy("file", "block").agg(
        F.count("*").alias("lines"),
        F.count(header(F.lit(1))).alias("pieces"),
        F.min(header(F.col("ord"))).alias("ord"),
        F.min_by(header(logtext.header_time(F.col("text"))), header(F.col("ord"))).alias("first"),
    )
    stats = stats.withColumn("head", F.when(F.col("pieces") > 0, F.struct("ord", "first", "pieces")))
    forward = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    return stats.select(
        "file",
        "block",
        "head",
        F.coalesce(F.sum("lines").over(forward), F.lit(0)).alias("lines_before"),
        F.last(F.when(F.col("head").isNotNull(), F.col("block")), ignorenulls=True).over(forward).alias("owner"),
        F.last("head", ignorenulls=True).over(backward).alias("next"),
    )


def _carried(dealt: DataFrame, context: DataFrame) -> DataFrame:
    """Per header block the non-blank lines that later blocks begin with, in order: the tail of its last entry.

    Lines without any header before them are dropped at the join, one by one; they are never gathered.
    """
    owned = context.where(F.col("owner").isNotNull()).select("file", "block", "owner", "head")
    before_headers = F.col("head").isNull() | (F.col("ord") < F.col("head.ord"))
    # One condition on both sides: parts of it below the shuffle would make that a shuffle of its own.
    leading = F.coalesce(~F.col("is_header") & (F.col("text") != "") & before_headers, F.lit(False))
    ordered = F.sort_array(F.collect_list(F.struct("block", "ord", "text")))
    lines = dealt.join(owned, ["file", "block"]).where(leading)
    return lines.groupBy("file", F.col("owner").alias("block")).agg(F.transform(ordered, lambda x: x["text"]).alias("carried"))


def assemble_entries(lines: DataFrame) -> DataFrame:
    """Complete log entries: header fields, joined continuation lines, line number and time gap. One job counts the lines first."""
    dealt = _dealt(lines)
    context = _block_context(dealt)
    entries = _pieces(_numbered(dealt)).join(context.drop("owner"), ["file", "block"]).join(_carried(dealt, context), ["file", "block"], "left")
    last_of_block = F.col("piece") == F.col("head.pieces")
    in_block = Window.partitionBy("file", "block").orderBy("piece")
    tail = F.coalesce("carried", F.array().cast("array<string>"))
    parts = F.when(last_of_block, F.concat("more", tail)).otherwise(F.col("more"))
    own = entries.withColumns(
        {
            "pos": F.col("lines_before") + F.col("first_line"),
            "details": F.array_join(parts, "\n"),
            "next_timestamp": F.when(last_of_block, F.col("next.first")).otherwise(
                F.lead("timestamp").over(in_block)
            ),
        }
    )
    gap = logtext.seconds_between(F.col("timestamp"), F.col("next_timestamp"))
    return conform(_with_message_parts(own.withColumn("time_diff_seconds", gap)), LOG_ENTRY)


def level_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy(F.lower("log_level").alias("log_level"), "function").agg(F.count("*").alias("count"))


def hourly_summary(entries: DataFrame) -> DataFrame:
    return entries.groupBy("date", "hour").agg(
        F.count("*").alias("log_count"),
        F.avg("time_diff_seconds").alias("avg_time_diff"),
        F.max("time_diff_seconds").alias("max_time_diff"),
    )


def count_by(entries: DataFrame, column: str) -> DataFrame:
    return entries.groupBy(column).agg(F.count("*").alias("count"))


def top_by(entries: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values; ties go to the smaller value."""
    return count_by(entries, column).orderBy(F.desc("count"), F.col(column).asc_nulls_last()).limit(n)


def metric_key(metric: str, key: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"))


def hour_key() -> Column:
    return F.concat(F.col("date").cast("string"), F.lit(" "), F.col("hour").cast("string"))


def metric_counts(entries: DataFrame) -> DataFrame:
    """Entries per metric and key, in one pass; the map tasks reduce to one row per metric and key."""
    pairs = F.array(
        metric_key("hour", hour_key()),
        metric_key("log_levels", F.lower("log_level")),
        metric_key("top_functions", F.col("function")),
        metric_key("top_usernames", F.col("username")),
        metric_key("top_ips", F.col("ip")),
    )
    return entries.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.key").agg(F.count("*").alias("n"))


def log_stats(entries: DataFrame, top: int = 10) -> DataFrame:
    return stats_from_counts(metric_counts(entries), top)


def stats_from_counts(counted: DataFrame, top: int = 10) -> DataFrame:
    """Statistics in long form (metric, key, value) from counts per metric and key."""
    is_hour = F.col("metric") == "hour"
    known_hour = F.when(is_hour & F.col("key").isNotNull(), F.col("n"))
    totals = counted.groupBy("metric", F.when(~is_hour, F.col("key")).alias("key")).agg(
        F.sum("n").alias("n"),
        F.min(F.substring("key", 1, 10)).alias("first_day"),
        F.max(F.substring("key", 1, 10)).alias("last_day"),
        F.try_divide(F.sum(known_hour), F.count(known_hour)).alias("per_hour"),
        F.max(known_hour).alias("peak"),
    )
    # Levels are all reported, so each is a ranking group of its own; the others are top lists.
    own_group = F.when(F.col("metric") == "log_levels", F.col("key"))
    ranking = Window.partitionBy("metric", own_group).orderBy(F.desc("n"), F.col("key").asc_nulls_last())
    kept = totals.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top)

    def row(metric, key, value) -> Column:
        return F.struct(metric.alias("metric"), key.alias("key"), value.cast("string").alias("value"))

    no_key = F.lit("")
    overall = F.array(
        row(F.lit("total_logs"), no_key, F.col("n")),
        row(F.lit("date_range"), F.lit("min"), F.col("first_day")),
        row(F.lit("date_range"), F.lit("max"), F.col("last_day")),
        row(F.lit("avg_logs_per_hour"), no_key, F.col("per_hour").cast("decimal(18,6)")),
        row(F.lit("max_logs_per_hour"), no_key, F.col("peak")),
    )
    listed = F.array(row(F.col("metric"), F.col("key"), F.col("n")))
    return kept.select(F.explode(F.when(is_hour, overall).otherwise(listed)).alias("r")).select("r.*")


def first_per_file(rows: DataFrame, n: int) -> DataFrame:
    """The first n lines or entries of every file; map tasks already drop later ones."""
    in_file = Window.partitionBy("file").orderBy("block", "ord")
    return rows.withColumn("nth", F.row_number().over(in_file)).where(F.col("nth") <= n)


def detect_format(lines: DataFrame, patterns: dict[str, str] = logtext.CANDIDATE_FORMATS, n: int = 10) -> DataFrame:
    """Per file and candidate pattern: how many of the first n lines match it."""
    head = first_per_file(lines, n).withColumn("text", strip(F.col("line")))
    scores = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("pattern"), logtext.matches(F.col("text"), rx).cast("long").alias("hit"))
                for name, rx in patterns.items()
            ]
        )
    )
    return (
        head.select("file", scores.alias("s"))
        .groupBy("file", "s.pattern")
        .agg(F.sum("s.hit").alias("matches"), F.count("*").alias("lines"))
    )


def sample_distribution(entries: DataFrame, n: int = 20, component: str = "function") -> DataFrame:
    """Level and component counts over the first n entries of every file."""
    pairs = F.explode(F.array(metric_key("log_level", F.col("log_level")), metric_key("component", F.col(component))))
    return (
        first_per_file(entries, n)
        .select("file", pairs.alias("p"))
        .groupBy("file", "p.metric", "p.key")
        .agg(F.count("*").alias("count"))
    )


def new_files(listing: DataFrame, ledger: DataFrame, path: str = "path") -> DataFrame:
    """Listed files whose base name is not in the ledger (column ``file_name``)."""
    named = listing.withColumn("file_name", F.substring_index(F.col(path), "/", -1))
    return named.join(ledger.select("file_name").distinct(), "file_name", "left_anti").select(*listing.columns)
