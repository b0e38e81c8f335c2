"""Patterns and column expressions for application-log lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimweave.functions.scalars import strip

# The header layouts and message layouts of the log format.
HEADER = r"(\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2})\s+\[([^\]]+)\]\s+\[([^\]]+)\]\s+(\w+)\s+(.*)"
STRICT_HEADER = r"(\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2})\s+\[([^\]]+)\]\s+\[([^\]]+)\]\s+(\w+)\s+([^\s]+)\s+\(([^)]+)\)\s+:(.*)"
COMPONENT_HEADER = r"(\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2})\s+(\w+)\s+\[([^\]]+)\]\s+(.*)"
CALL_PREFIX = r"^(\S+)\s+\(([^)]+)\)\s+:\s*(.*)"
CANDIDATE_FORMATS = {
    "header": HEADER,
    "strict": STRICT_HEADER,
    "component": COMPONENT_HEADER,
    "log4j": r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})\s+(\w+)\s+\[([^\]]+)\]\s+(.*)$",
    "iso": r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z)\s+(\w+)\s+(.*)$",
    "slashes": r"^(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2})\s+(\w+)\s+(.*)$",
}

HEADER_FIELDS = ["timestamp", "ip", "username", "log_level", "message"]
STRICT_FIELDS = ["timestamp", "ip", "username", "log_level", "function", "file_info", "message"]
COMPONENT_FIELDS = ["timestamp", "log_level", "component", "message"]


def anchored(pattern: str) -> str:
    """The pattern matched from the line start, with Unicode classes and only \\n as line end."""
    return "(?Ud)^" + pattern.removeprefix("^")


def matches(line: Column, pattern: str) -> Column:
    return line.rlike(anchored(pattern))


def parse_timestamp(text: Column) -> Column:
    """Zoneless timestamp; null for an impossible date instead of failing the whole job."""
    joined = F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 8))
    return joined.try_cast("timestamp_ntz")


def header_fields(line: Column, pattern: str = HEADER, names: list[str] = HEADER_FIELDS) -> list[Column]:
    """One column per capture group of a header line. A null line gives nulls; other lines must not occur."""
    rx = anchored(pattern)
    fields = []
    for group, name in enumerate(names, start=1):
        value = F.regexp_extract(line, rx, group)
        if name == "timestamp":
            value = parse_timestamp(value)
        elif name == "message":
            value = strip(value)
        fields.append(value.alias(name))
    return fields


def header_time(line: Column) -> Column:
    """The timestamp of a header line: its first 19 characters."""
    return parse_timestamp(line)


def entry_fields(line: Column) -> list[Column]:
    """What `header_fields` gives for HEADER, from one match instead of one per field.

    A bracket ends the fields in the rewritten line, as none of the first three can hold one; a message ends where the line does.
    """
    parts = F.split(F.regexp_replace(line, anchored(HEADER), "$2]$3]$4]$5"), "]", 4)
    message = strip(F.substring_index(parts[3], "\n", 1))
    return [header_time(line).alias("timestamp"), *[parts[i].alias(HEADER_FIELDS[i + 1]) for i in range(3)], message.alias("message")]


def _called(message: Column) -> Column:
    """The function that a message begins with; empty without one."""
    return F.regexp_extract(message, anchored(CALL_PREFIX), 1)


def function_name(message: Column) -> Column:
    return F.when(_called(message) != "", _called(message)).otherwise("unknown")


def file_info(message: Column) -> Column:
    return F.regexp_extract(message, anchored(CALL_PREFIX), 2)


def clean_message(message: Column) -> Column:
    return F.when(_called(message) != "", F.regexp_extract(message, anchored(CALL_PREFIX), 3)).otherwise(message)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds between two zoneless timestamps, whatever the session time zone."""

    def of_day(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    days = F.datediff(F.to_date(later), F.to_date(earlier))
    return (days * F.lit(86400).cast("long") + of_day(later) - of_day(earlier)).cast("double")
