"""Cheapest repair of the role order of conversations.

A repaired conversation has no rows, or an optional system row and then pairs of user and assistant. Every row is kept, gets
another role or is deleted, and empty rows are inserted. The choices are edges of a DAG whose nodes are (row, what the
output ends with). Each edge has one integer as weight: the high digits are its cost, the low ones the letter
of its edit, at its place in a number of fixed width; places behind the last letter are zero. So an ordinary minimum over
integers finds the cheapest edits, and of these the ones whose letters come first.

Rows of a conversation are worked off in blocks from the last to the first. A block takes over the costs behind it: at a node all
edges have different letters, so that equal costs are told apart in the block. A block keeps four numbers, and from
these the letters are read from first to last: a conversation costs a task a few bytes a row, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bazaarlake.llm.duck import crc32_sql
from bazaarlake.llm.storage import write_table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Letters of edits by their digit, in the order of ASCII; 0 is the place behind the end.
LETTERS = "".join(["\0", *sorted((KEEP, REROLE, DELETE, INSERT))])
DIGIT = {letter: i for i, letter in enumerate(LETTERS)}
BITS = 3
BLOCK_ROWS = 64
#: A row has its own letter and two inserts before it at most.
WIDTH = BITS * 3 * BLOCK_ROWS
LOW = (1 << WIDTH) - 1
# What the output ends with: nothing, the system row, a user's or an assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that may come next, and the state it leads to.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ROWS_PER_BATCH = 1000
WHITE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")


class Costs(NamedTuple):
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Row(NamedTuple):
    """What a repair needs to know of a row."""

    initial: str
    blank: bool
    duplicate: bool
    truncated: bool


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row is kept as it is, if it may be."""
    if state == START and initial == "s":
        return SYSTEM
    role, to = NEXT[state]
    return to if initial == role[0] else None


def weight(cost: int, letter: str, behind: int) -> int:
    """An edge's weight and what lies behind it: costs add up, and the letter comes before the letters behind."""
    return ((behind >> WIDTH) + cost << WIDTH) + (DIGIT[letter] << WIDTH - BITS) + ((behind & LOW) >> BITS)


def _inserted(best: list[int | None], cost: int) -> list[int | None]:
    """The least weights at a gap, where rows may be inserted; more than two never pay."""
    found = list(best)
    for state, sources in ((USER, best), (ASSISTANT, best), (START, found), (SYSTEM, found)):
        behind = sources[NEXT[state][1]]
        if behind is not None:
            found[state] = min((w for w in (best[state], weight(cost, INSERT, behind)) if w is not None))
    return found


def _end(costs: Costs) -> list[int]:
    """The least weights behind the last row: no rows at all or an assistant's row may be the end."""
    return _inserted([0, None, None, 0], costs.insert)


def _row(row: Row, behind: list[int], costs: Costs) -> list[int]:
    """The least weight at each state before a row."""
    found = []
    for state in range(4):
        edges = [weight(costs.delete, DELETE, behind[state])]
        if not row.blank and not row.duplicate:
            extra, to = costs.truncated * row.truncated, kept_state(state, row.initial)
            edges.append(weight(costs.rerole + extra, REROLE, behind[NEXT[state][1]]))
            if to is not None:
                edges.append(weight(extra, KEEP, behind[to]))
        found.append(min(edges))
    return _inserted(found, costs.insert)


def letters(number: int) -> str:
    """The letters of the low digits."""
    low, found = number & LOW, []
    for at in range(WIDTH - BITS, -1, -BITS):
        digit = low >> at & (1 << BITS) - 1
        if not digit:
            break
        found.append(LETTERS[digit])
    return "".join(found)


class Repair:
    """The cheapest repair of one conversation, whose rows come from the last to the first."""

    def __init__(self, costs: Costs) -> None:
        self.costs, self.behind, self.held = costs, _end(costs), 0
        # The four numbers of each block, and the initials of its rows; the first one is the end.
        self.blocks: list[tuple[list[int], str]] = [(self.behind, "")]
        self.behind, self.initials = [w >> WIDTH << WIDTH for w in self.behind], []

    def add(self, row: Row) -> None:
        self.behind = _row(row, self.behind, self.costs)
        self.initials.append(row.initial or "-")
        if len(self.initials) == BLOCK_ROWS:
            self._close()

    def _close(self) -> None:
        self.blocks.append((self.behind, "".join(reversed(self.initials))))
        self.behind, self.initials = [w >> WIDTH << WIDTH for w in self.behind], []

    def result(self) -> tuple[int, str]:
        """Cost and letters."""
        self._close()
        state, found = START, []
        for numbers, initials in reversed(self.blocks):
            found.append(letters(numbers[state]))
            rows = iter(initials)
            for letter in found[-1]:
                initial = next(rows) if letter != INSERT else ""
                if letter == KEEP:
                    state = kept_state(state, initial)
                elif letter != DELETE:
                    state = NEXT[state][1]
        return self.blocks[-1][0][START] >> WIDTH, "".join(found)


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of every row of the repaired conversation; rows are read one by one."""
    state = START
    for letter in audit:
        role, text = next(rows) if letter != INSERT else ("", "")
        if letter == DELETE:
            continue
        if letter == KEEP:
            state = kept_state(state, role[:1])
        else:
            role, state = NEXT[state]
        yield role, text


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Conversation:
    """Counts and repair of one conversation, whose rows come from the last to the first."""

    def __init__(self, conv_id, costs: Costs) -> None:
        self.conv_id, self.repair, self.first, self.last = conv_id, Repair(costs), None, None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.after = None

    def add(self, turn: int | None, row: Row) -> None:
        if turn is not None:
            self.turns += turn != self.first
            self.first, self.last = turn, turn if self.last is None else self.last
        self.blank, self.duplicate = self.blank + row.blank, self.duplicate + row.duplicate
        self.truncated += row.truncated
        self.illegal += self.after is not None and (row.initial, self.after) not in LEGAL
        self.after = row.initial
        self.repair.add(row)

    def result(self) -> tuple:
        cost, audit = self.repair.result()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, ROWS_PER_BATCH)):
        arrays = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(marked: DataFrame, *last: str) -> T.StructType:
    fields = [*(T.StructField(c, T.LongType()) for c in SUMMARY), *(T.StructField(c, T.StringType()) for c in last)]
    return T.StructType([marked.schema["conv_id"], *fields])


def mark(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the first fault of each row, written; nulls of role and text count as one space."""
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"))
    seen = rows.withColumns(
        {
            "_end": F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1)),
            "_digest": F.unhex(F.sha2("text", 256)),
            "_order": F.struct(F.col("turn").isNotNull(), "turn", F.monotonically_increasing_id()),
        }
    )
    seen = write_table(seen, "conversation-rows")
    # Copies are counted down before the shuffle; a written table lets rows of a frequent text be split.
    firsts = seen.filter("_end <> ''").groupBy("conv_id", "role", "_digest").agg(F.min("_order").alias("_first"))
    firsts = write_table(firsts.select(F.col("conv_id").alias("_id"), F.col("role").alias("_role"), F.col("_digest").alias("_text"), "_first"), "conversation-firsts")
    same = F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("role") == F.col("_role")) & (F.col("_digest") == F.col("_text"))
    blank = F.col("_end") == ""
    duplicate = ~blank & (F.col("_order") != F.col("_first"))
    marked = seen.join(firsts, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        blank.alias("blank"),
        F.coalesce(duplicate, F.lit(False)).alias("duplicate"),
        F.coalesce(~blank & ~duplicate & ~F.col("_end").isin(*ENDS), F.lit(False)).alias("truncated"),
    )
    return write_table(marked, "conversation-marked")


def audits(marked: DataFrame, costs: Costs) -> DataFrame:
    """conv_id, the counts of SUMMARY and audit of every conversation of marked rows (see mark)."""
    if min(costs) < 0 or not costs.insert:
        raise ValueError("costs must not be negative, and an insert must cost something")
    schema = _schema(marked, "audit")
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            own = None
            for batch in batches:
                for conv_id, turn, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if own is None or own.conv_id != conv_id:
                        if own is not None:
                            yield own.result()
                        own = _Conversation(conv_id, costs)
                    own.add(turn, Row(*row))
            if own is not None:
                yield own.result()

        yield from _batches(found(), arrow)

    down = [F.col(c).desc_nulls_last() for c in ("turn", "role", "text", "duplicate")]
    dealt = marked.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *down)
    narrow = dealt.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "duplicate", "truncated")
    return narrow.mapInArrow(scan, schema)


def _behind_audits(marked: DataFrame, found: DataFrame) -> DataFrame:
    """The audits found, each followed by the rows of its conversation, which have no audit; role and text come last."""
    rows = marked.select("conv_id", "turn", "role", "text", F.lit(1).alias("_is_row"))
    both = found.withColumn("_is_row", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "_is_row", "turn", "role", "text")]
    dealt = both.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", *SUMMARY, "audit", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """(conv_id, counts, audit) and the repaired rows of each conversation, read while they are asked for."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    ahead = [next(rows, None)]

    def own() -> Iterator[tuple[str, str]]:
        for row in rows:
            if row[-3] is not None:
                ahead.append(row)
                return
            yield row[-2:]
        ahead.append(None)

    while (head := ahead.pop()) is not None:
        left = own()
        yield head[:-2], repaired(head[-3], left)
        if next(left, None) is not None:
            raise ValueError("an audit is shorter than its conversation")


def with_hashes(marked: DataFrame, found: DataFrame) -> DataFrame:
    """The audits found, with repaired_sha256."""
    schema = _schema(marked, "audit", "repaired_sha256")
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            for head, rows in _streamed(batches):
                digest, between = hashlib.sha256(), b""
                for role, text in rows:
                    digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    between = b"\n"
                yield *head, digest.hexdigest()

        yield from _batches(hashed(), arrow)

    return _behind_audits(marked, found).mapInArrow(scan, schema)


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation of rows.

    rows are (conv_id, turn, role, text), other columns are not looked at. They are taken by turn, null turns first, then by
    role and text; what is repeated in full is a duplicate but for the first. Rows without a conv_id are one conversation. Of
    an empty table nothing comes. A conversation's rows stream through one task, as the hash of its repaired
    text goes from row to row; sorting spills to disk, and the task holds about a byte for each row.
    """
    marked = mark(rows)
    return with_hashes(marked, write_table(audits(marked, costs), "conversation-audits"))


def repaired_rows(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """conv_id, position (from 0), role and text of the repaired conversations, see repair."""
    marked = mark(rows)
    fields = [T.StructField("position", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    schema = T.StructType([marked.schema["conv_id"], *fields])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((head[0], n, *row) for head, own in _streamed(batches) for n, row in enumerate(own))
        yield from _batches(found, arrow)

    found = write_table(audits(marked, costs), "conversation-audits")
    return _behind_audits(marked, found).mapInArrow(scan, schema)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by a hash of conv_id and turn; nulls of any column count as one space, but for the order."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    fault = F.col("_fault")
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_fault"))
    changed = marked.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return changed.drop("_copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """repair of damaged rows, with one result for every conversation of the undamaged ones."""
    found = write_table(repair(damage(rows)), "conversation-repairs")
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in SUMMARY]
    nothing = hashlib.sha256().hexdigest()
    return every.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def _least(*edges: str) -> str:
    return f"list_min([{', '.join(edges)}])"


def _edge(cost: str, letter: str, behind: str, when: str | None = None) -> str:
    edge = f"{{'c': {behind}.c + {cost}, 'l': '{letter}' || {behind}.l}}"
    return f"CASE WHEN {when} THEN {edge} ELSE {{'c': 1000000000::BIGINT, 'l': ''}} END" if when else edge


def _state_sql(state: str, to: str, role: str) -> str:
    keep = f"NOT must_go AND initial = '{role}'"
    edges = [_edge("3", DELETE, state), _edge("2 + extra", REROLE, to, "NOT must_go"), _edge("extra", KEEP, to, keep)]
    if state == "e":
        edges.append(_edge("extra", KEEP, "s", "NOT must_go AND initial = 's'"))
    return f"{_least(*edges)} AS {state}"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS hx
  FROM conversations),
drawn AS (SELECT *, {crc32_sql("hx")} % 20 AS fault FROM keyed),
ids AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT ids.conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn JOIN ids ON drawn.conv_id IS NOT DISTINCT FROM ids.conv_id,
    unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copies(copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS initial,
    right(rtrim(text, {_BLANKS}), 1) AS ending FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) AS nth,
    lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
marked AS (
  SELECT *, ending = '' AS blank, ending <> '' AND nth > 1 AS duplicate,
    ending <> '' AND nth = 1 AND ending NOT IN ('.', '!', '?') AS truncated FROM seen),
rows_ AS (SELECT conv, i, role, text, initial, blank OR duplicate AS must_go, CAST(truncated AS BIGINT) AS extra FROM marked),
summary AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv),
best(conv, i, e, s, u, a) AS (
  SELECT conv, max(i) + 1, {{'c': 0::BIGINT, 'l': ''}}, {{'c': 4::BIGINT, 'l': 'II'}}, {{'c': 2::BIGINT, 'l': 'I'}},
    {{'c': 0::BIGINT, 'l': ''}} FROM rows_ GROUP BY conv
  UNION ALL
  SELECT conv, i, {_least("e", _edge("2", INSERT, "nu"))}, {_least("s", _edge("2", INSERT, "nu"))}, nu, na
  FROM (
    SELECT *, {_least("u", _edge("2", INSERT, "a"))} AS nu, {_least("a", _edge("2", INSERT, "u"))} AS na
    FROM (
      SELECT conv, i, {_state_sql("e", "u", "u")}, {_state_sql("s", "u", "u")}, {_state_sql("u", "a", "a")},
        {_state_sql("a", "u", "u")}
      FROM (SELECT b.conv, r.i, e, s, u, a, must_go, initial, extra FROM best b JOIN rows_ r ON r.conv = b.conv AND r.i = b.i - 1)))),
chosen AS (SELECT conv, e.c AS cost, e.l AS audit FROM best WHERE i = 1),
steps AS (SELECT conv, unnest(range(1, length(audit) + 1)) AS place, audit FROM chosen),
lettered AS (SELECT conv, place, substr(audit, place, 1) AS letter FROM steps),
counted AS (
  SELECT *, count(*) FILTER (letter <> '{INSERT}') OVER (PARTITION BY conv ORDER BY place) AS i,
    count(*) FILTER (letter <> '{DELETE}') OVER (PARTITION BY conv ORDER BY place) AS k FROM lettered),
joined AS (
  SELECT c.conv, c.place, c.k, c.letter, CASE WHEN c.letter <> '{INSERT}' THEN r.role END AS role,
    CASE WHEN c.letter = '{INSERT}' THEN '' ELSE r.text END AS text
  FROM counted c LEFT JOIN rows_ r ON r.conv = c.conv AND r.i = c.i WHERE c.letter <> '{DELETE}'),
offsets AS (SELECT *, max(CAST(k = 1 AND letter = '{KEEP}' AND role[1] = 's' AS BIGINT)) OVER (PARTITION BY conv) AS shift FROM joined),
hashes AS (
  SELECT conv, sha256(string_agg(CASE WHEN letter = '{KEEP}' THEN role WHEN (k - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY place)) AS repaired FROM offsets GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN summary USING (conv) LEFT JOIN chosen USING (conv) LEFT JOIN hashes USING (conv)
"""
