"""Conversation structure repair: the cheapest edits to a legal order of roles.

Legal is an optional system message, then one or more pairs of user and assistant; or nothing.
Only a role's first letter counts. Messages are taken by turn (missing ones first), then role and
text. A blank message, and one whose role and text came before, must be deleted; a message that
does not end in ``.``, ``!`` or ``?`` is truncated and costs ``TRUNCATED`` more unless deleted. Of
the cheapest edit sequences the ASCII-least is taken: D(elete), I(nsert an empty message), K(eep),
R(erole).

The dynamic program knows four states: what the last kept message was. Going backward, the least
cost to the end from every state is stored at checkpoints only, one every square root of the rows;
going forward, the stretch between two checkpoints is computed again and the first edit that is
tight is taken. That is the least sequence: no tied one is another's prefix.

A conversation above ``block_rows`` distinct messages is cut into blocks, so that no task gathers
it. Each block gives the least cost from every state in to every state out; folding those backward
gives the costs at its end, a walk from every state what state it ends in, folding those forward
its real entry; then all blocks walk at once. What is gathered per conversation is one small row a
block, and at last the blocks' outputs, streamed in order through one digest.

Nulls in role and text are one blank. A missing conv_id is a conversation of its own. Equal rows
are as many messages. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import isqrt
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.llm.common import SPACES, WORD, materialize, table
from airloom.llm.sql import crc32_sql
from airloom.operators.ordered import slice_hot_groups

BLOCK_ROWS = 4096

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 40

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after keeping a message whose role begins so.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after an inserted or reroled message: always what has to come next.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Least cost to a legal end from each state.
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}

Costs = tuple[int, int, int, int]


class Message(NamedTuple):
    """What the program sees of a row: its role's letter, whether it must go, its extra cost."""

    letter: str
    dead: bool
    extra: int


DEAD = Message("", True, 0)


def _closed(costs: list[int]) -> Costs:
    """With insertions; three would only come back to where one leads."""
    out = []
    for q in range(4):
        once = NEXT[q]
        out.append(min(costs[q], INSERT + costs[once], 2 * INSERT + costs[NEXT[once]], FAR))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def before(message: Message, after: Costs) -> Costs:
    """Least costs in front of a message, from those behind it."""
    costs = []
    for q in range(4):
        least = DELETE + after[q]
        if not message.dead:
            least = min(least, REROLE + message.extra + after[NEXT[q]])
            kept = KEPT.get(message.letter, {}).get(q)
            if kept is not None:
                least = min(least, message.extra + after[kept])
        costs.append(least)
    return _closed(costs)


@lru_cache(maxsize=1 << 16)
def edits(message: Message, after: Costs, q: int) -> tuple[str, int]:
    """The least tight edits at a message from a state, and the state after them."""
    left, done = before(message, after), ""
    while True:
        kept = KEPT.get(message.letter, {}).get(q)
        if DELETE + after[q] == left[q]:
            return done + "D", q
        if INSERT + left[NEXT[q]] == left[q]:
            done, q = done + "I", NEXT[q]
        elif kept is not None and message.extra + after[kept] == left[q]:
            return done + "K", kept
        else:
            return done + "R", NEXT[q]


def _lowered(costs: Costs) -> tuple[Costs, int]:
    """The same above its smallest, which keeps the number of different vectors small."""
    least = min(costs)
    return tuple(c - least if c < FAR else FAR for c in costs), least


class Block:
    """A stretch of a conversation's messages with their costs at checkpoints."""

    def __init__(self, messages: list[Message], at_end: Costs = AT_END) -> None:
        self.messages = messages
        self.step = isqrt(len(messages)) + 1
        at, least = _lowered(_closed(list(at_end)))
        self.marks = {len(messages): at}
        for i in range(len(messages) - 1, -1, -1):
            at, more = _lowered(before(messages[i], at))
            least += more
            if i % self.step == 0:
                self.marks[i] = at
        #: Least cost from every state at the front.
        self.costs = tuple(min(c + least, FAR) for c in at)

    def walk(self, q: int) -> Iterator[tuple[str, int, int]]:
        """Per message its edits, the state before and the state after."""
        n = len(self.messages)
        for a in range(0, n, self.step):
            b = min(a + self.step, n)
            behind = [self.marks[b]]
            for message in reversed(self.messages[a + 1 : b]):
                behind.append(_lowered(before(message, behind[-1]))[0])
            for message, after in zip(self.messages[a:b], reversed(behind), strict=True):
                letters, then = edits(message, after, q)
                yield letters, q, then
                q = then


def ending(q: int) -> str:
    """The insertions that end a conversation legally."""
    return {SYSTEM: "II", USER: "I"}.get(q, "")


def inserted(letters: str, q: int) -> Iterator[tuple[int, str]]:
    """State and line of every insertion among a message's edits."""
    for _ in range(letters.count("I")):
        q = NEXT[q]
        yield q, f"{ROLES[q]}:"


def messages(turns: DataFrame) -> DataFrame:
    """Distinct messages with the number of their copies and their faults."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    same = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES.decode())), F.lit(1))
    rows = rows.withColumns(
        {"same": same, "blank": ~F.col("text").rlike(WORD), "open": ~last.isin(".", "!", "?")}
    )
    # A message's first place is one row, so this join has no key twice on either side.
    firsts = rows.groupBy("conv_id", "same").agg(F.min(F.struct("turn")).alias("at"))
    firsts = firsts.select(
        F.col("conv_id").alias("c"), F.col("same").alias("s"), F.col("at.turn").alias("t"), F.lit(True).alias("first")
    )
    match = (F.col("same") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    rows = rows.join(firsts, match, "left").drop("c", "s", "t", "same")
    return rows.withColumn("first", F.coalesce("first", F.lit(False)))


def faults(rows: DataFrame) -> DataFrame:
    """Counts per conversation: gaps between turns, blank, duplicate and truncated messages."""
    copies = F.col("copies")
    own = F.col("first").cast("long")
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), copies - own).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & F.col("open"), own).otherwise(0)).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


def _program(rows: list[tuple]) -> list[Message]:
    """Rows of (role, text, copies, first, blank, open) as messages; later copies are dead."""
    out = []
    for role, _, copies, first, blank, open_ in rows:
        live = first and not blank
        out.append(Message(role[:1], False, TRUNCATED * open_) if live else DEAD)
        out += [DEAD] * (copies - 1)
    return out


def _illegal(rows: list[tuple]) -> int:
    """Neighbours whose letters may not follow each other; copies are neighbours too."""
    letters = [r[0][:1] for r in rows]
    pairs = sum(a + b not in LEGAL for a, b in zip(letters, letters[1:], strict=False))
    return pairs + sum(r[2] - 1 for r in rows)


def _repaired(rows: list[tuple], block: Block, q: int) -> tuple[str, list[str], int]:
    """Edits, repaired lines and last state of a block entered in a state."""
    audit, lines = [], []
    steps = block.walk(q)
    for role, text, copies, *_ in rows:
        for k in range(copies):
            letters, q, then = next(steps)
            audit.append(letters)
            for q, line in inserted(letters, q):
                lines.append(line)
            # Only a first copy can stay.
            if letters[-1] == "K" and k == 0:
                lines.append(f"{role}:{text}")
            elif letters[-1] == "R":
                lines.append(f"{ROLES[then]}:{text}")
            q = then
    return "".join(audit), lines, q


#: What the program reads of a row, after its conversation and block.
ROW = ["role", "text", "copies", "first", "blank", "open"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple], tuple]]:
    """Conversation and block, rows, and the columns after these, of every block of sorted rows."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    width = 2 + len(ROW)
    for key, own in groupby(rows(), key=itemgetter(0, 1)):
        own = list(own)
        yield key, [r[2:width] for r in own], own[0][width:]


def _over_blocks(rows: DataFrame, order: list, more: list[str], work, columns: str) -> DataFrame:
    """``work`` on every block of a table, its rows in order; what it yields with the block's key."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, block array<int>, {columns}"
    target = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, found, held = to_arrow_schema(target), [], 0

        def flush() -> pa.RecordBatch:
            cells = zip(*found, strict=True) if found else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, kinds, strict=True)], schema=kinds)

        for key, own, rest in _blocks(batches):
            out = work(own, *rest)
            found.append((*key, *out))
            held += 100 + sum(len(x) for x in out if isinstance(x, (str, bytes)))
            if held > BATCH_BYTES:
                yield flush()
                found, held = [], 0
        yield flush()

    dealt = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", *order)
    return dealt.select("conv_id", "block", *ROW, *more).mapInArrow(run, target)


def _per_conversation(blocks: DataFrame, column: str, kind: str, fold) -> DataFrame:
    """Adds what ``fold`` makes of a conversation's blocks in order: one small row each."""
    target = T.StructType.fromDDL(f"{_ddl(blocks)}, {column} {kind}")

    def run(group: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        rows = sorted(group.to_pylist(), key=itemgetter("block"))
        for row, value in zip(rows, fold(rows), strict=True):
            row[column] = value
        return pa.Table.from_pylist(rows, schema=to_arrow_schema(target))

    return blocks.groupBy("conv_id").applyInArrow(run, target)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _ways(own: list[tuple]) -> tuple[list[int]]:
    """Least cost from every state in to every state out, row by row."""
    program = _program(own)
    ends = [tuple(0 if q == end else FAR for q in range(4)) for end in range(4)]
    costs = [Block(program, end).costs for end in ends]
    return ([costs[out][q] for q in range(4) for out in range(4)],)


def _costs_behind(blocks: list[dict]) -> list[list[int]]:
    """Costs at the end of every block, from the last one backward."""
    behind = [list(AT_END)]
    for block in reversed(blocks[1:]):
        after, ways = behind[-1], block["ways"]
        behind.append([min(min(ways[4 * q + out] + after[out] for out in range(4)), FAR) for q in range(4)])
    return behind[::-1]


def _ends_in(own: list[tuple], behind: list[int]) -> tuple[list[int]]:
    """The state every state in leads to."""
    block = Block(_program(own), tuple(behind))
    out = []
    for q in range(4):
        if block.costs[q] < FAR:
            for _, _, q in block.walk(q):
                pass
        out.append(q)
    return (out,)


def _entries(blocks: list[dict]) -> list[int]:
    entries = [START]
    for block in blocks[:-1]:
        entries.append(block["leads"][entries[-1]])
    return entries


def _mended(own: list[tuple], behind: list[int], entry: int, last: bool) -> tuple:
    """Output of a block: cost to the end, illegal neighbours, outer letters, edits, lines."""
    block = Block(_program(own), tuple(behind))
    audit, lines, q = _repaired(own, block, entry)
    if last:
        audit += ending(q)
        while q in (SYSTEM, USER):
            q = NEXT[q]
            lines.append(f"{ROLES[q]}:")
    outer = own[0][0][:1], own[-1][0][:1]
    return block.costs[entry], _illegal(own), *outer, audit, "\n".join(lines).encode()


OUTPUT = "cost long, illegal long, opens string, closes string, audit string, text binary"
BATCH_BYTES = 8_000_000


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (conv_id, block, cost, illegal, opens, closes, audit, text) from ``messages``.

    A conversation within the bound has one row and no block number. Of others ``block`` orders
    the parts: audits and texts (lines ``role:text``; empty if nothing is left) follow each other,
    the first part's cost is the whole one's, and neighbours across parts are still to be judged.
    """
    cut, keys = slice_hot_groups(rows, ["conv_id"], ["turn", "role", "text"], block_rows)
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]

    def alone(own: list[tuple]) -> tuple:
        return _mended(own, list(AT_END), START, True)

    block = F.array(*[F.col(k) for k in keys]) if keys else F.array().cast("array<int>")
    cut = cut.withColumn("block", block)
    whole = cut.where(F.col(keys[0]) < 0).withColumn("block", F.array().cast("array<int>")) if keys else cut
    done = _over_blocks(whole, order, [], alone, OUTPUT)
    if not keys:
        return done

    dealt = cut.where(F.col(keys[0]) >= 0).repartition("conv_id", "block")
    dealt = dealt.sortWithinPartitions("conv_id", "block", *order).withColumn("place", F.monotonically_increasing_id())
    placed = materialize(dealt.select("conv_id", "block", "place", *ROW), "blocks")
    letters = placed.withColumns({"role": F.left("role", F.lit(1)), "text": F.lit("")})

    def with_(rows: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
        side = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), *columns)
        return rows.join(side, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")

    ways = materialize(_over_blocks(letters, ["place"], [], _ways, "ways array<long>"), "block-ways")
    behind = materialize(_per_conversation(ways, "behind", "array<long>", _costs_behind).drop("ways"), "block-costs")
    leads = _over_blocks(with_(letters, behind, "behind"), ["place"], ["behind"], _ends_in, "leads array<int>")
    leads = materialize(leads, "block-leads")
    entries = _per_conversation(leads, "entry", "int", _entries).drop("leads")
    last = leads.groupBy("conv_id").agg(F.max("block").alias("final"))
    last = last.select(F.col("conv_id").alias("c"), "final")
    entries = entries.join(last, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    entries = materialize(entries.withColumn("last", F.col("block") == F.col("final")).drop("final"), "block-entries")
    given = with_(with_(placed, behind, "behind"), entries, "entry", "last")
    parts = _over_blocks(given, ["place"], ["behind", "entry", "last"], _mended, OUTPUT)
    return done.unionByName(parts)


DIGEST = "cost long, illegal long, audit string, repaired_sha256 string"


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation; parts of large ones stream through one digest in order."""
    parts = materialize(parts, "repaired")
    many = F.size("block") > 0
    whole = parts.where(~many).select("conv_id", "cost", "illegal", "audit", F.sha2("text", 256).alias("repaired_sha256"))
    kind = parts.schema["conv_id"].dataType.simpleString()
    target = T.StructType.fromDDL(f"conv_id {kind}, {DIGEST}")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, kept = to_arrow_schema(target), ["conv_id", "cost", "illegal", "opens", "closes", "audit", "text"]

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(len(batch)):
                    yield tuple(batch.column(c)[i].as_py() for c in kept)

        for conv, own in groupby(rows(), key=itemgetter(0)):
            digest, audits, illegal, cost, before_, empty = hashlib.sha256(), [], 0, None, None, True
            for _, left, pairs, opens, closes, audit, text in own:
                cost = left if cost is None else cost
                illegal += pairs + (before_ is not None and before_ + opens not in LEGAL)
                before_ = closes
                audits.append(audit)
                if text:
                    digest.update(text if empty else b"\n" + text)
                    empty = False
            row = (conv, cost, illegal, "".join(audits), digest.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

    dealt = parts.where(many).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return whole.unionByName(dealt.mapInArrow(join, target))


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the result."""
    rows = materialize(messages(turns), "messages")
    counts = faults(rows).withColumnRenamed("conv_id", "c")
    found = digests(repaired(rows, block_rows))
    return found.join(counts, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def damaged(turns: DataFrame) -> DataFrame:
    """The same messages with faults that a hash of their place chooses."""
    name, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    h = F.crc32(F.encode(F.concat(name, F.lit(":"), turn), "UTF-8")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    out = turns.select(
        "conv_id",
        "turn",
        F.when(h == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        h.alias("h"),
    ).where("h > 0")
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("copy", F.explode(copies)).drop("h", "copy")


def op13_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = repair(damaged(turns)).withColumnRenamed("conv_id", "c")
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


_EDITS_SQL = "(values " + ", ".join(
    [f"({q}, '', {q}, 0, '')" for q in range(4)]
    + [f"({q}, 'I', {NEXT[q]}, {INSERT}, '{ROLES[NEXT[q]]}:')" for q in range(4)]
    + [f"({q}, 'II', {NEXT[NEXT[q]]}, {2 * INSERT}, '{ROLES[NEXT[q]]}:' || chr(10) || '{ROLES[NEXT[NEXT[q]]]}:')" for q in range(4)]
) + ") as t(q, letters, mid, cost, lines)"
_MOVES_SQL = "(values " + ", ".join(
    [f"({q}, 'D', {q}, null, null)" for q in range(4)]
    + [f"({q}, 'R', {NEXT[q]}, '{ROLES[NEXT[q]]}', null)" for q in range(4)]
    + [f"({q}, 'K', {then}, null, '{letter}')" for letter, ways in KEPT.items() for q, then in ways.items()]
) + ") as m(mid, letter, q, role, wants)"

SQL = f"""
with recursive hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as h
    from conversations),
after_damage as (
    select conv_id, turn, case when h = 4 then 'user' else role end as role,
           case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(case when h = 3 then [0, 1] else [0] end) as copy
    from hashed where h > 0),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
           row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
           regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g') as plain
    from after_damage),
judged as (
    select *, plain in ('', ' ') as blank, plain not in ('', ' ') and seen > 1 as duplicate,
           plain not in ('', ' ') and seen = 1 and right(rtrim(plain), 1) not in ('.', '!', '?') as truncated,
           lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
    from placed),
counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
           count(*) filter (truncated) as truncated,
           count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, max(i) as n
    from judged group by conv_id),
inserts as (select * from {_EDITS_SQL}),
moves as (select * from {_MOVES_SQL}),
walk as (
    select conv_id, 0::bigint as i, 0 as q, struct_pack(cost := 0, audit := '') as best, [''][1:0] as lines from counts
    union all
    select conv_id, i, q, min(best), arg_min(lines, best) from (
        select w.conv_id, j.i, m.q,
               struct_pack(cost := w.best.cost + t.cost
                   + case when m.letter = 'D' then {DELETE}
                          else (m.letter = 'R')::int * {REROLE} + j.truncated::int * {TRUNCATED} end,
                   audit := w.best.audit || t.letters || m.letter) as best,
               list_concat(list_concat(w.lines, case when t.lines = '' then [] else [t.lines] end),
                   case when m.letter = 'D' then [] else [coalesce(m.role, j.role) || ':' || j.text] end) as lines
        from walk w
        join judged j on j.conv_id is not distinct from w.conv_id and j.i = w.i + 1
        join inserts t on t.q = w.q
        join moves m on m.mid = t.mid and (m.letter = 'D' or not (j.blank or j.duplicate))
             and (m.wants is null or m.wants = left(j.role, 1)))
    group by conv_id, i, q),
ends as (
    select w.conv_id, struct_pack(cost := w.best.cost + t.cost, audit := w.best.audit || t.letters) as best,
           list_concat(w.lines, case when t.lines = '' then [] else [t.lines] end) as lines
    from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.i
    join inserts t on t.q = w.q and t.mid in ({START}, {ASSISTANT})),
chosen as (select conv_id, min(best) as best, arg_min(lines, best) as lines from ends group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
       coalesce(best.audit, '') as audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) e
left join counts c on c.conv_id is not distinct from e.conv_id
left join chosen h on h.conv_id is not distinct from e.conv_id"""
