"""Conversation structure repair with a suffix-shared automaton of role/fault signatures.

A conversation's signature has one symbol per row, in order: the class of its role, in capitals if the text is truncated, or `x` for a row that
has to go (blank or duplicate). What the cheapest repair of a suffix costs depends on that suffix and on the grammar's state alone, so
signatures are minimised from the end: suffixes that any conversations share are one node of a DAWG, whose cost-to-go and best edit are computed
once per grammar state. Nodes whose costs differ by a constant only are one class, and a transition between classes is computed once per worker.
Sorting signatures by their reverse brings shared suffixes together; conversations of equal signatures are neighbours, and are spread
over partitions by their id, so neither a common signature nor a common suffix makes a hot task.

Passes:
1. `profiles`. Thin rows (no texts, but their digests) are reduced to cells of equal rows; a cell's first turn comes from a join that Spark splits
   on hot keys; cells are range-partitioned by conversation and turn, so a long conversation is cut over tasks, whose signature
   pieces are put together per conversation.
2. `plans`. Profiles are range-partitioned by reversed signature, and the DAWG is walked along its sorted paths.
3. `repaired` and `report`. Rows follow their conversation's audit in one sorted stream. Here a conversation is read by one task,
   since a SHA-256 of it is one chain; nothing but the current batch is held.

Defined results. Nulls of any column read as one space, but a null conv_id is a conversation of its own, and null turns come first. Rows of equal turn
are ordered by role, then by the MD5 of their content. Repeated rows are duplicates. Empty tables give empty results. Texts of any length stay whole.
Other columns are not read, whatever their names. gaps is null where turns are so far apart that it does not fit a long.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark import TaskContext

from llm.common import groups, utf8

_BLANKS = " \t\n\x0b\x0c\r"

# -- the automaton --------------------------------------------------------------------------------------

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_NEVER = 1 << 40

# Grammar states of `(s?(ua)+)?`: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Where s, u and a lead from each state.
STEP = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
#: The only role that can be put in at each state.
NEXT_ROLE = ("user", "user", "assistant", "user")

#: An edit: (initial, state behind it, whether it uses up the row).
Edit = tuple[str, int, bool]


def _with_inserts(options: list[tuple[int, str, Edit | None]]) -> tuple[tuple[int, ...], tuple[Edit | None, ...]]:
    """(cost, edit) of each state when rows may be inserted as well; at equal costs the lesser initial wins."""
    best = list(options)
    for _ in range(3):
        for state in range(4):
            to = STEP[state][NEXT_ROLE[state][0]]
            best[state] = min(best[state], (best[to][0] + INSERT, "I", ("I", to, False)), key=lambda o: o[:2])
    return tuple(o[0] for o in best), tuple(o[2] for o in best)


class Dawg:
    """Signatures sorted by their reverse, one after the other: the path from the end is the stack, shared suffixes stay on it.

    A class is a tuple of cost differences between states; moves has, per symbol and class, what lies one symbol further from the end.
    """

    def __init__(self):
        costs, edits = _with_inserts([(0, "", None), (_NEVER, "~", None), (_NEVER, "~", None), (0, "", None)])
        self.moves: dict[tuple[str, tuple], tuple[int, tuple, tuple]] = {}
        self.path = ""  # reversed signature
        self.nodes = [(min(costs), tuple(c - min(costs) for c in costs), edits)]  # cost, class, edits by state
        self.made = 0

    def _move(self, symbol: str, after: tuple) -> tuple[int, tuple, tuple]:
        role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        options = []
        for state in range(4):
            own = [(after[state] + DELETE, "D", ("D", state, True))]
            if symbol != "x":
                to = STEP[state].get(role)
                if to is not None:
                    own.append((after[to] + KEEP + extra, "K", ("K", to, True)))
                to = STEP[state][NEXT_ROLE[state][0]]
                own.append((after[to] + REROLE + extra, "R", ("R", to, True)))
            options.append(min(own, key=lambda o: o[:2]))
        costs, edits = _with_inserts(options)
        least = min(costs)
        return least, tuple(c - least for c in costs), edits

    def plan(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of the cheapest repair, of equals the one whose audit is ASCII-least."""
        path = signature[::-1]
        shared = len(os.path.commonprefix([path, self.path]))
        del self.nodes[shared + 1 :]
        for symbol in path[shared:]:
            base, after, _ = self.nodes[-1]
            found = self.moves.get((symbol, after))
            if found is None:
                found = self.moves[symbol, after] = self._move(symbol, after)
            self.nodes.append((base + found[0], found[1], found[2]))
            self.made += 1
        self.path = path
        cost, differences, _ = self.nodes[-1]
        state, at, audit = START, len(self.nodes) - 1, []
        while (edit := self.nodes[at][2][state]) is not None:
            audit.append(edit[0])
            state, at = edit[1], at - edit[2]
        return cost + differences[START], "".join(audit)


# -- rows -------------------------------------------------------------------------------------------------


def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with rows dropped, emptied, stripped of stops, repeated or re-roled, by crc32 of `conv_id:turn`."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times)).drop("col")


def _content(rows: DataFrame) -> Column:
    """Digest of conversation, role and text."""
    whose = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(whose, F.lit("\0"), "role", F.lit("\0"), "text")))


def _clean(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"), _or_space("text").alias("text"))


_FRAGMENT = "piece long, signature string, first_initial string, last_initial string, first_turn long, last_turn long, least_turn long, turns long, blank long, duplicate long, truncated long, illegal long"
_FRAGMENT_NAMES = [f.split()[0] for f in _FRAGMENT.split(", ")]


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a run of a conversation's sorted cells (conv_id, turn, initial, symbol, n, is_first) adds to its profile, batch by batch."""
    piece = TaskContext.get().partitionId() << 32
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ["conv_id", *_FRAGMENT_NAMES]}
        last = object()
        for conv, turn, initial, symbol, n, is_first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv != last:
                last, piece = conv, piece + 1
                for k, v in zip(out, (conv, piece, [], initial, initial, turn, turn, turn, int(turn is not None), 0, 0, 0, 0), strict=True):
                    out[k].append(v)
            else:
                out["turns"][-1] += turn is not None and turn != out["last_turn"][-1]
                out["illegal"][-1] += not _legal(out["last_initial"][-1] + initial)
                out["last_initial"][-1], out["last_turn"][-1] = initial, turn
                if out["least_turn"][-1] is None:
                    out["least_turn"][-1] = turn
            out["illegal"][-1] += n - 1
            if symbol == "x":
                out["blank"][-1] += n
            else:
                out["duplicate"][-1] += n - is_first
                out["truncated"][-1] += bool(is_first) and symbol.isupper()
            out["signature"][-1].append(symbol + "x" * (n - 1) if is_first else "x" * n)
        out["signature"] = ["".join(s) for s in out["signature"]]
        types = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, *[pa.int64()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def profiles(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, signature, gaps, blank, duplicate, truncated and illegal. conv_ids names conversations that may have no rows left."""
    bare = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(bare == "", "x").when(F.substring(bare, -1, 1).isin(".", "!", "?"), known).otherwise(F.upper(known))
    clean = _clean(rows)
    thin = clean.select("conv_id", "turn", "role", _content(clean).alias("content"), symbol.alias("symbol"))
    cells = thin.groupBy("conv_id", "turn", "role", "content", "symbol").agg(F.count("*").alias("n"))
    # Both sides are shuffled right below the join, which lets Spark split a content that fills a third of all turns.
    first = cells.groupBy("content").agg(F.max(F.col("turn").isNull()).alias("any_null"), F.min("turn").alias("first"))
    first = first.select(F.hex("content").alias("key"), "any_null", "first")
    flagged = cells.withColumn("key", F.hex("content")).join(first, "key")
    is_first = F.when(F.col("any_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    order = ["conv_id", "turn", "role", "content"]
    spread = flagged.select(*order, F.substring("role", 1, 1).alias("initial"), "symbol", "n", F.coalesce(is_first, F.lit(False)).alias("is_first"))
    spread = spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("role", "content")
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = spread.mapInArrow(_fragments, f"conv_id {kind}, {_FRAGMENT}")
    if conv_ids is not None:
        empty = {n: F.lit(0).cast("long") for n in ("piece", "turns", "blank", "duplicate", "truncated", "illegal")} | {"signature": F.lit("")}
        named = conv_ids.select(F.col("conv_id").cast(kind).alias("conv_id")).distinct()
        found = found.unionByName(named.select("conv_id", *[v.alias(k) for k, v in empty.items()]), allowMissingColumns=True)
    parts = F.sort_array(F.collect_list(F.when(F.col("signature") != "", F.struct(*_FRAGMENT_NAMES[:6]))))
    whole = found.groupBy("conv_id").agg(
        parts.alias("parts"), F.min("least_turn").alias("least"), F.max("last_turn").alias("most"), *[F.sum(n).alias(n) for n in _FRAGMENT_NAMES[7:]]
    )
    # At a joint of two parts a turn may be on both sides, and roles may clash.
    joints = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda i: F.struct(F.col("parts")[i - 1].alias("l"), F.col("parts")[i].alias("r")))
    joints = F.when(F.size("parts") > 1, joints).otherwise(F.array().cast(f"array<struct<l:struct<{_struct()}>,r:struct<{_struct()}>>>"))
    same = F.size(F.filter("joints", lambda j: j["l"]["last_turn"] == j["r"]["first_turn"]))
    clash = F.size(F.filter("joints", lambda j: ~F.concat(j["l"]["last_initial"], j["r"]["first_initial"]).isin("su", "ua", "au")))
    span = F.try_subtract("most", "least")
    return whole.withColumn("joints", joints).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["signature"]), "").alias("signature"),
        F.when(F.col("most").isNull(), 0).otherwise(F.try_add(span, 1 - (F.col("turns") - same))).alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + clash).alias("illegal"),
    )


def _struct() -> str:
    return ",".join(f.replace(" ", ":") for f in _FRAGMENT.split(", ")[:6])


def plans(found: DataFrame) -> DataFrame:
    """profiles with cost and audit; the signature is dropped. One walk of the DAWG per partition, in the order of reversed signatures."""
    order = [F.reverse("signature"), F.col("conv_id")]
    names = [c for c in found.columns if c != "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dawg, last, known = Dawg(), None, (0, "")
        for batch in batches:
            costs, audits = [], []
            for signature in batch.column(0).to_pylist():
                if signature != last:
                    last, known = signature, dawg.plan(signature)
                costs.append(known[0])
                audits.append(known[1])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(costs, pa.int64()), pa.array(audits, pa.string())], [*names, "cost", "audit"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "signature"], "cost long, audit string"])
    return found.repartitionByRange(*order).sortWithinPartitions(*order).select("signature", *names).mapInArrow(run, schema)


# -- repaired rows ------------------------------------------------------------------------------------------

_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _stream(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's audit (is_row false, in text), then its rows in order: conv_id, is_row, role, text and the plan's columns."""
    clean = _clean(rows)
    columns = ["conv_id", "is_row", "turn", "role", "content", "text"]
    lines = clean.select("conv_id", F.lit(True).alias("is_row"), "turn", "role", _content(clean).alias("content"), "text")
    heads = planned.select("conv_id", F.lit(False).alias("is_row"), F.col("audit").alias("text"), *_STATS)
    both = lines.unionByName(heads, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*columns[:5]).select("conv_id", "is_row", "role", "text", *_STATS)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object, object, object]]:
    """("audit", conv_id, audit, stats) of each conversation, then ("row", edit, role, text) of each row that is left."""
    audit, at, state = "", 0, START

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, at = NEXT_ROLE[state], at + 1
            state = STEP[state][role[0]]
            yield "row", "I", role, ""

    for batch in batches:
        _, offsets, _ = utf8(batch.column(3))
        for a, b in groups(offsets):
            columns = [c.slice(a, b - a).to_pylist() for c in batch.columns]
            for conv, is_row, role, text, *stats in zip(*columns, strict=True):
                yield from inserted()
                if not is_row:
                    audit, at, state = text, 0, START
                    yield "audit", conv, audit, stats
                    continue
                edit, at = audit[at], at + 1
                if edit == "R":
                    role = NEXT_ROLE[state]
                if edit != "D":
                    state = STEP[state][role[0]]
                    yield "row", edit, role, text
    yield from inserted()


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position from 0, role, text and the edit that made them (K, R or I)."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, conv, position, size = None, [[] for _ in range(5)], None, 0, 0

        def typed(stream):
            nonlocal of
            for batch in stream:
                of = batch.schema.field(0).type
                yield batch

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(held, (of, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], ["conv_id", "position", "role", "text", "edit"])

        for what, x, y, z in _edited(typed(batches)):
            if what == "audit":
                conv, position = x, 0
                continue
            for column, v in zip(held, (conv, position, y, z, x), strict=True):
                column.append(v)
            position, size = position + 1, size + len(z) + 32
            if size > 4 << 20:
                yield flush()
                held, size = [[] for _ in range(5)], 0
        if held[0]:
            yield flush()

    return _stream(rows, planned).mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")


def report(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Per conversation: the plan's columns and repaired_sha256 of its repaired rows (`role:text`, joined by newlines)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *_STATS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, done, digest, size = None, [], None, 0

        def typed(stream):
            nonlocal of
            for batch in stream:
                of = batch.schema.field(0).type
                yield batch

        def flush():
            types = [of, *[pa.int64()] * len(_STATS), pa.string(), pa.string()]
            columns = zip(*[(conv, *stats, audit, h.hexdigest()) for conv, stats, audit, h in done], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names)

        for what, x, y, z in _edited(typed(batches)):
            if what == "audit":
                if size > 4 << 20:
                    yield flush()
                    done, size = [], 0
                digest, between = hashlib.sha256(), b""
                done.append((x, z, y, digest))
                size += len(y) + 400
            else:
                digest.update(between + f"{y}:{z}".encode())
                between = b"\n"
        if done:
            yield flush()

    schema = ", ".join([f"conv_id {kind}", *[f"{n} long" for n in _STATS], "audit string", "repaired_sha256 string"])
    return _stream(rows, planned).mapInArrow(run, schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, profile, plan and repair all conversations; one row per original conv_id, those without rows left included."""
    rows = damage(conversations)
    return report(rows, plans(profiles(rows, conversations.select("conv_id"))))


REPORT_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS codes
  FROM conversations
), damaging AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, codes), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM damaging WHERE kind <> 0
), placed AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER w AS pos, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
    md5(coalesce('=' || conv_id::VARCHAR, '-') || chr(0) || role || chr(0) || text) AS content
  FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(coalesce('=' || conv_id::VARCHAR, '-') || chr(0) || role || chr(0) || text))
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, content ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
  FROM placed
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list({'r': initial, 'x': CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END, 't': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END} ORDER BY pos) AS row_list
  FROM judged GROUP BY conv_id
), walk AS (
  SELECT conv_id, row_list, n AS pos, {'c': 0, 'a': ''} AS n0, {'c': 10, 'a': 'II'} AS n1, {'c': 5, 'a': 'I'} AS n2, {'c': 0, 'a': ''} AS n3 FROM facts
  UNION ALL
  SELECT conv_id, row_list, pos - 1,
    list_sort([b0, {'c': 5 + v2.c, 'a': 'I' || v2.a}])[1], list_sort([b1, {'c': 5 + v2.c, 'a': 'I' || v2.a}])[1], v2, list_sort([b3, {'c': 5 + b2.c, 'a': 'I' || b2.a}])[1]
  FROM (
    SELECT *, list_sort([b2, {'c': 5 + b3.c, 'a': 'I' || b3.a}])[1] AS v2 FROM (
      SELECT conv_id, row_list, pos,
        list_sort([{'c': 2 + n0.c, 'a': 'D' || n0.a}, {'c': 1 + q.t + q.x + n2.c, 'a': 'R' || n2.a},
          CASE q.r WHEN 'u' THEN {'c': q.t + q.x + n2.c, 'a': 'K' || n2.a} WHEN 's' THEN {'c': q.t + q.x + n1.c, 'a': 'K' || n1.a} ELSE {'c': 2000000000, 'a': ''} END])[1] AS b0,
        list_sort([{'c': 2 + n1.c, 'a': 'D' || n1.a}, {'c': 1 + q.t + q.x + n2.c, 'a': 'R' || n2.a},
          CASE q.r WHEN 'u' THEN {'c': q.t + q.x + n2.c, 'a': 'K' || n2.a} ELSE {'c': 2000000000, 'a': ''} END])[1] AS b1,
        list_sort([{'c': 2 + n2.c, 'a': 'D' || n2.a}, {'c': 1 + q.t + q.x + n3.c, 'a': 'R' || n3.a},
          CASE q.r WHEN 'a' THEN {'c': q.t + q.x + n3.c, 'a': 'K' || n3.a} ELSE {'c': 2000000000, 'a': ''} END])[1] AS b2,
        list_sort([{'c': 2 + n3.c, 'a': 'D' || n3.a}, {'c': 1 + q.t + q.x + n2.c, 'a': 'R' || n2.a},
          CASE q.r WHEN 'u' THEN {'c': q.t + q.x + n2.c, 'a': 'K' || n2.a} ELSE {'c': 2000000000, 'a': ''} END])[1] AS b3
      FROM (SELECT *, row_list[pos] AS q FROM walk WHERE pos > 0)))
), planned AS (
  SELECT conv_id, n0.c AS cost, n0.a AS audit FROM walk WHERE pos = 0
), steps AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(len(audit))) AS k FROM planned WHERE audit <> ''
), numbered AS (
  SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS pos FROM steps
), written AS (
  SELECT s.conv_id, s.k, s.edit, j.role, j.initial, j.text, row_number() OVER (PARTITION BY s.conv_id ORDER BY s.k) AS e
  FROM numbered s LEFT JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND s.pos = j.pos AND s.edit <> 'I' WHERE s.edit <> 'D'
), headed AS (
  SELECT *, max(CASE WHEN e = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS has_s FROM written
), hashed AS (
  SELECT conv_id, sha256(string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN (e - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS h
  FROM headed GROUP BY conv_id
)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
  coalesce(f.illegal, 0) AS illegal, coalesce(p.cost, 0)::BIGINT AS cost, coalesce(p.audit, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN planned p ON c.conv_id IS NOT DISTINCT FROM p.conv_id
LEFT JOIN hashed h ON c.conv_id IS NOT DISTINCT FROM h.conv_id
"""
