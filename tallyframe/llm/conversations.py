"""Repair of conversations by the cheapest edits, found by dynamic programming over runs.

A conversation should read as an optional system message and then user and assistant in turns. Every message is kept, given
another role, or deleted, and empty messages may be inserted. A message is one of nine symbols: one that has to go
(blank, or role and text seen earlier), or a kind of role with or without an end of sentence. Equal symbols in
a row are one run, and a run of any length is passed by the binary powers of its symbol's min-plus matrix over
the four states of the pattern. A second walk then reads off the edits.

Spark folds equal messages before anything is sorted, finds first occurrences by partial aggregation, and hands
each conversation to a task in two parts: its symbols in order, then the texts that may stay, in the same order. A task
therefore holds the symbols and edits of one conversation, a few bytes a message, and never its texts.
The digest of a repaired conversation is one hash over its messages in order, so they pass through one task; copies
and blanks do not.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import table

# White space, ends of a sentence, and what edits cost.
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: States of the pattern: nothing yet, after system, after user, after assistant; the state that a new message leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: 0 has to go; 1 to 4 are the kinds of role, 5 to 8 the same without an end of sentence.
INITIALS = {"s": 1, "u": 2, "a": 3}
FAR, BLOCK = 1 << 60, 1024
#: Kinds of cells that Spark counts: no message left, blank, without an end of sentence, whole.
GONE, BLANK, OPEN, WHOLE = range(4)

Vector = tuple[int, int, int, int]
#: Costs from the end: nothing is missing at the start and after an assistant.
END: Vector = (0, 2 * INSERT, INSERT, 0)


def kept_state(symbol: int, state: int) -> int | None:
    """Where a kept message leads; None where it does not fit."""
    kind = (symbol - 1) % 4 + 1 if symbol else 0
    if kind == 1:
        return SYSTEM if state == START else None
    if kind == 2:
        return None if state == USER else USER
    return ASSISTANT if kind == 3 and state == USER else None


def transition(symbol: int) -> list[list[int]]:
    """Cheapest way from state to state over one message, insertions before it included."""
    one = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        one[state][state] = DELETE
        if symbol:
            extra = CUT if symbol > 4 else 0
            to = NEXT[state]
            one[state][to] = min(one[state][to], REROLE + extra)
            if (to := kept_state(symbol, state)) is not None:
                one[state][to] = min(one[state][to], extra)
    insert = [[0 if a == b else INSERT if NEXT[a] == b else FAR for b in range(4)] for a in range(4)]
    return product(product(insert, insert), one)


def product(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    return [[min(FAR, min(left[i][k] + right[k][j] for k in range(4))) for j in range(4)] for i in range(4)]


class Costs:
    """Steps over runs, remembered: powers of each symbol's matrix, and what they make of a vector of costs.

    Vectors are kept relative to their least entry, so that few different ones occur."""

    def __init__(self):
        self.powers = {s: [transition(s)] for s in range(9)}
        self.steps: dict[tuple, tuple[Vector, int]] = {}
        self.rows: dict[tuple, tuple[str, str, int]] = {}

    def power(self, symbol: int, bit: int) -> list[list[int]]:
        held = self.powers[symbol]
        while len(held) <= bit:
            held.append(product(held[-1], held[-1]))
        return held[bit]

    def before(self, symbol: int, count: int, costs: Vector) -> tuple[Vector, int]:
        """Costs before ``count`` equal messages, from those after them, and what was taken off."""
        total, bit = 0, 0
        while count >> bit:
            if count >> bit & 1:
                key = symbol, bit, costs
                found = self.steps.get(key)
                if found is None:
                    matrix = self.power(symbol, bit)
                    raw = [min(m + c for m, c in zip(row, costs)) for row in matrix]
                    least = min(raw)
                    found = self.steps[key] = tuple(x - least for x in raw), least
                costs = found[0]
                total += found[1]
            bit += 1
        return costs, total

    def row(self, symbol: int, after: Vector, state: int) -> tuple[str, str, int]:
        """Edits up to and with one message: for the audit, for the texts (without messages that have to go), new state."""
        key = symbol, after, state
        if key not in self.rows:
            fresh, least = self.before(symbol, 1, after)
            audit, at = "", state
            while True:
                cost = fresh[at] + least
                if DELETE + after[at] == cost:
                    self.rows[key] = audit + "D", audit + "X" if symbol else audit, at
                    break
                if INSERT + fresh[NEXT[at]] + least == cost:
                    audit, at = audit + "I", NEXT[at]
                    continue
                extra, kept = CUT if symbol > 4 else 0, kept_state(symbol, at)
                if kept is not None and extra + after[kept] == cost:
                    self.rows[key] = audit + "K", audit + "K", kept
                else:
                    self.rows[key] = audit + "R", audit + "R", NEXT[at]
                break
        return self.rows[key]

    def solve(self, symbols: array, counts: array) -> tuple[int, str, str]:
        """Least cost, audit and edits of the texts for runs of symbols."""
        ends, costs, total = [END] * len(symbols), END, 0
        for i in range(len(symbols) - 1, -1, -1):
            ends[i] = costs
            costs, more = self.before(symbols[i], counts[i], costs)
            total += more
        total += costs[START]
        audit, plan, state = [], [], START
        for symbol, count, end in zip(symbols, counts, ends):
            left = count
            while left:
                size = min(left, BLOCK)
                left -= size
                after = [self.before(symbol, left, end)[0]]
                for _ in range(size - 1):
                    after.append(self.before(symbol, 1, after[-1])[0])
                for costs in reversed(after):
                    edits, texts, state = self.row(symbol, costs, state)
                    audit.append(edits)
                    plan.append(texts)
        while END[state]:
            audit.append("I")
            plan.append("I")
            state = NEXT[state]
        return total, "".join(audit), "".join(plan)


class Conversation:
    """What a task holds of the conversation it reads."""

    def __init__(self, key, costs: Costs):
        self.key, self.solver = key, costs
        self.symbols, self.counts = array("b"), array("q")
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.before = None
        self.distinct, self.first = 0, None
        self.plan: str | None = None
        self.at, self.state, self.place = 0, START, 0
        self.digest = hashlib.sha256()

    def add(self, symbol: int, count: int) -> None:
        if not count:
            return
        if self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += count
        else:
            self.symbols.append(symbol)
            self.counts.append(count)

    def cell(self, turn: int | None, role: str, digest: bytes, kind: int, count: int) -> None:
        """Equal messages of one turn, in order."""
        if kind == GONE:
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        initial = role[:1]
        self.illegal += count - 1 + (self.before is not None and self.before + initial not in ("su", "ua", "au"))
        self.before = initial
        if kind == BLANK:
            self.blank += count
            self.add(0, count)
            return
        if self.first == (turn, role, digest):
            self.truncated += kind == OPEN
            self.add(INITIALS.get(initial, 4) + (4 if kind == OPEN else 0), 1)
            count -= 1
        self.duplicate += count
        self.add(0, count)

    def decide(self) -> None:
        if self.plan is None:
            self.cost, self.audit, self.plan = self.solver.solve(self.symbols, self.counts)

    def _put(self, role: str, text: str, edit: str) -> tuple:
        self.digest.update((("\n" if self.place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.place += 1
        return self.key, self.place, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        """Messages to insert at this place."""
        while self.at < len(self.plan) and self.plan[self.at] == "I":
            self.state = NEXT[self.state]
            self.at += 1
            yield self._put(NAMES[self.state], "", "I")

    def text(self, role: str, text: str) -> Iterator[tuple]:
        """The next message that may stay, with what is inserted before it."""
        self.decide()
        yield from self.inserted()
        edit = self.plan[self.at]
        self.at += 1
        if edit == "K":
            self.state = kept_state(INITIALS[role[:1]], self.state)
            yield self._put(role, text, edit)
        elif edit == "R":
            self.state = NEXT[self.state]
            yield self._put(NAMES[self.state], text, edit)

    def close(self) -> Iterator[tuple]:
        self.decide()
        yield from self.inserted()

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, 2**63 - 1)
        found = gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return self.key, *found, self.audit, self.digest.hexdigest()


SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
MESSAGES = "place long, edit string, role string, text string"


def ordered(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Symbols and texts of (conv, turn, role, text, present), a conversation after the other, in one task each.

    Per conversation: cells of equal messages of a turn (``step`` 1, after a mark with ``step`` 0 where the first one with
    this role and text is among them), then the texts of the first ones. Only the second part carries texts."""
    held = rows.select("conv", "turn", "role", "text", "present", (copies if copies is not None else F.lit(1)).cast("long").alias("copies"))
    bare = F.rtrim("text", F.lit(SPACES))
    kind = F.when(~F.col("present"), GONE).when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(*ENDS), WHOLE).otherwise(OPEN)
    held = held.withColumn("kind", kind)
    # A dropped message leaves nothing but its conversation.
    left = lambda name: F.when(F.col("kind") != GONE, F.col(name))
    digest = F.unhex(F.sha2("text", 256))
    cells = held.select("conv", left("turn").alias("turn"), left("role").alias("role"), F.when(F.col("kind") != GONE, digest).alias("digest"), "kind", "copies")
    cells = cells.groupBy("conv", "turn", "role", "digest", "kind").agg(F.sum("copies").alias("n"))
    firsts = held.where(F.col("kind") > BLANK).groupBy("conv", "role", "text").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("phase"), F.lit(None).cast("string").alias("text")), F.struct(F.lit(1).alias("phase"), F.col("text"))))
    firsts = firsts.select("conv", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", digest.alias("digest"), both.alias("part"))
    names = ["conv", "phase", "turn", "role", "digest", "step", "kind", "n", "text"]
    marks = firsts.select("conv", "part.phase", "turn", "role", "digest", F.lit(0).alias("step"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("long").alias("n"), "part.text")
    cells = cells.withColumns({"phase": F.lit(0), "step": F.lit(1), "text": F.lit(None).cast("string")})
    return marks.select(*names).unionAll(cells.select(*names)).repartition("conv").sortWithinPartitions(*names[:6])


def mended(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[tuple]:
    """Repaired messages (``whole``) or one summary per conversation, from ordered rows."""
    costs, open_ = Costs(), None

    def finish(one: Conversation) -> Iterator[tuple]:
        closing = list(one.close())
        yield from closing if whole else [one.summary()]

    for batch in batches:
        for key, phase, turn, role, digest, step, kind, n, text in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ is None or open_.key != key:
                if open_ is not None:
                    yield from finish(open_)
                open_ = Conversation(key, costs)
            if phase:
                put = list(open_.text(role, text))
                if whole:
                    yield from put
            elif step:
                open_.cell(turn, role, digest, kind, n)
            else:
                open_.first = turn, role, digest
        if len(costs.steps) + len(costs.rows) > 100_000:
            costs.steps.clear()
            costs.rows.clear()
    if open_ is not None:
        yield from finish(open_)


def _mend(rows: DataFrame, whole: bool, copies: Column | None) -> DataFrame:
    layout = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T.StructType.fromDDL(MESSAGES if whole else SUMMARY).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kinds = {"string": pa.string(), "bigint": pa.int64()}
        types = [first.schema.field("conv").type, *(kinds[f.dataType.simpleString()] for f in layout.fields[1:])]

        def again() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for _, part in groupby(enumerate(mended(again(), whole)), lambda x: x[0] // 500):
            columns = zip(*(row for _, row in part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], layout.names)

    return ordered(rows, copies).mapInArrow(run, layout)


def messages(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Columns of the operator's own names; a null role or text is one space."""
    def filled(name: str) -> Column:
        return F.coalesce(rows[name].cast("string"), F.lit(" "))

    return rows.select(
        rows[conv_id].alias("conv"), rows[turn].cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), F.lit(True).alias("present")
    )


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired messages: ``conv``, ``place`` from 1, ``edit`` (K kept, R given another role, I inserted), ``role``, ``text``.

    ``rows`` as of ``messages``. Messages are in order of turn (nulls first), then role, then SHA-256 of the text, so
    ties have one order and equal messages are neighbours. Rows without a conversation are one conversation. A role that
    does not begin with s, u or a (an empty one too) does not fit the pattern and is changed or deleted.
    Repeated rows are duplicates. An empty table, and a conversation whose messages all go, give no rows."""
    return _mend(rows, True, copies)


def diagnose(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conversation: faults, least cost, audit, and the hash of what ``repair`` gives.

    A conversation that has no message left (``present`` is false in all its rows) has zeros, an empty audit and the
    hash of an empty text. Gaps beyond the range of a long are given as its largest value."""
    return _mend(rows, False, copies)


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Faults planted by the checksum of conversation and turn, and how often each message then occurs."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")))
    planted = F.crc32(key.cast("binary")) % 20
    text = F.when(planted == 1, "").when(planted == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(planted == 4, "user").otherwise(F.col("role"))
    made = rows.select("conv", "turn", role.alias("role"), text.alias("text"), (planted != 0).alias("present"), F.when(planted == 3, 2).otherwise(1).alias("times"))
    return made, F.col("times")


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return diagnose(*damage(rows)).withColumnRenamed("conv", "conv_id")


OP13_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::UBIGINT) AS octets
  FROM conversations
), summed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::UBIGINT], octets), lambda c, b:
    list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))),
    4294967295::UBIGINT) % 20 AS planted
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN planted = 4 THEN 'user' ELSE role END AS role,
         CASE planted WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN planted = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM summed WHERE planted <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed
), marked AS (
  SELECT *, blank OR again AS dead, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM faulty
), steps AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, {c: 0, a: ''} AS s0, {c: 1000000000, a: ''} AS s1, {c: 5, a: 'I'} AS s2, {c: 10, a: 'II'} AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, place, n0, n1, m2, list_min([n3, {c: m2.c + 5, a: m2.a || 'I'}]) FROM (
    SELECT *, list_min([n2, {c: n0.c + 5, a: n0.a || 'I'}, {c: n1.c + 5, a: n1.a || 'I'}, {c: n3.c + 5, a: n3.a || 'I'}]) AS m2 FROM (
      SELECT s.conv_id, m.place, {c: s0.c + 2, a: s0.a || 'D'} AS n0,
        list_min([{c: s1.c + 2, a: s1.a || 'D'}, {c: s0.c + extra + CASE WHEN NOT dead AND initial = 's' THEN 0 ELSE 100000000 END, a: s0.a || 'K'}]) AS n1,
        list_min([{c: s2.c + 2, a: s2.a || 'D'}, {c: p2.c + extra + CASE WHEN NOT dead AND initial = 'u' THEN 0 ELSE 100000000 END, a: p2.a || 'K'},
                  {c: p2.c + extra + CASE WHEN dead THEN 100000000 ELSE 1 END, a: p2.a || 'R'}]) AS n2,
        list_min([{c: s3.c + 2, a: s3.a || 'D'}, {c: s2.c + extra + CASE WHEN NOT dead AND initial = 'a' THEN 0 ELSE 100000000 END, a: s2.a || 'K'},
                  {c: s2.c + extra + CASE WHEN dead THEN 100000000 ELSE 1 END, a: s2.a || 'R'}]) AS n3
      FROM (SELECT *, list_min([s0, s1, s3]) AS p2 FROM steps) s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.place = s.place + 1))
), best AS (
  SELECT conv_id, list_min([arg_max(s0, place), arg_max(s3, place)]) AS found FROM steps GROUP BY conv_id
), edits AS (
  SELECT conv_id, unnest(string_split(found.a, '')) AS edit, generate_subscripts(string_split(found.a, ''), 1) AS j FROM best WHERE found.a <> ''
), consumed AS (
  SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY j) AS place FROM edits
), stays AS (
  SELECT c.conv_id, c.edit, c.j, m.role, m.text, m.initial, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.j) AS e
  FROM consumed c LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM c.conv_id AND m.place = c.place AND c.edit <> 'I' WHERE c.edit <> 'D'
), counted AS (
  SELECT *, e - max(CASE WHEN e = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS k FROM stays
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS whole
  FROM counted GROUP BY conv_id
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT dead) AS truncated,
         count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
)
SELECT b.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
       coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(s.illegal, 0)::BIGINT AS illegal, b.found.c::BIGINT AS cost, b.found.a AS audit,
       sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM best b LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""
