"""Conversation repair as a lightest derivation: which edits, at the least cost, make the turns alternate.

An item (i, state) says that the first i turns are dealt with and what the repaired conversation needs next. Deductions
keep, rerole or delete a turn or insert one; a value is (cost, audit), the audit being the initials of the edits. Values
only grow along a deduction and keep their order, so Knuth's agenda, which pops the least value first, settles every item
once. Turns are reduced in blocks that know nothing of each other: a block is a table of lightest values from every state
to every state, and tables of consecutive blocks are combined by the same agenda. A conversation of any length is thus
dealt with in many tasks.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import WORD, stored

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What an undeleted truncated turn adds.
TRUNCATED = 5
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. Step: state, role initial -> state.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
#: Turns in a block, blocks combined at once.
BLOCK, FAN = 256, 64

Value = tuple[int, str]
Deduction = tuple[int, str, Hashable]


def lightest(axiom: Hashable, deduce: Callable[[Hashable], Iterable[Deduction]], goal: Hashable = None) -> dict[Hashable, Value]:
    """The least (cost, audit) of every item that can be derived from the axiom, or of those settled before the goal.

    ``deduce`` gives (cost, initials, conclusion) of the deductions that have an item as premise.
    """
    agenda: list[tuple[int, str, Hashable]] = [(0, "", axiom)]
    settled: dict[Hashable, Value] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in settled:
            continue
        settled[item] = cost, audit
        if item == goal:
            break
        for more, initials, conclusion in deduce(item):
            if conclusion not in settled:
                heapq.heappush(agenda, (cost + more, audit + initials, conclusion))
    return settled


def edits(turns: str) -> Callable[[tuple[int, int]], Iterator[Deduction]]:
    """The deductions over a block. A turn is x where it must go, else the initial of its role (s, u, a, o for any other),
    in capitals where the turn is truncated."""
    def deduce(item: tuple[int, int]) -> Iterator[Deduction]:
        i, state = item
        for initial in "ua":
            if (after := STEP.get((state, initial))) is not None:
                yield COST[INSERT], INSERT, (i, after)
        if i == len(turns):
            return
        yield COST[DELETE], DELETE, (i + 1, state)
        turn = turns[i]
        if turn == "x":
            return
        broken = TRUNCATED if turn.isupper() else 0
        if (after := STEP.get((state, turn.lower()))) is not None:
            yield COST[KEEP] + broken, KEEP, (i + 1, after)
        for initial in "ua":
            if (after := STEP.get((state, initial))) is not None:
                yield COST[REROLE] + broken, REROLE, (i + 1, after)

    return deduce


@functools.lru_cache(10_000)
def block_table(turns: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, audit) of a block."""
    return tuple((state, end, *value) for state in STATES
                 for (i, end), value in sorted(lightest((0, state), edits(turns)).items()) if i == len(turns))


def combined(tables: list[list]) -> list[tuple[int, int, int, str]]:
    """The table of consecutive blocks."""
    moves = [[[(cost, audit, end) for start, end, cost, audit in table if start == state] for state in STATES] for table in tables]

    def deduce(item: tuple[int, int]) -> Iterator[Deduction]:
        k, state = item
        if k < len(moves):
            yield from ((cost, audit, (k + 1, end)) for cost, audit, end in moves[k][state])

    return [(state, end, *value) for state in STATES
            for (k, end), value in sorted(lightest((0, state), deduce).items()) if k == len(tables)]


def answer(tables: list[list]) -> Value:
    """The value of the goal: nothing left to do after the last block and the conversation may end."""
    def deduce(item: Hashable) -> Iterator[Deduction]:
        if item == "goal":
            return
        k, state = item
        if k == len(tables):
            if state in FINAL:
                yield 0, "", "goal"
        else:
            yield from ((cost, audit, (k + 1, end)) for start, end, cost, audit in tables[k] if start == state)

    return lightest((0, 0), deduce, "goal")["goal"]


def _summary(turns: str, initials: str) -> str:
    legal = sum(initials[i:i + 2] in ("su", "ua", "au") for i in range(len(initials) - 1))
    return json.dumps([initials[0], initials[-1], len(initials) - 1 - legal, block_table(turns)])


def _merged(parts: list[str]) -> tuple[str, str, int, list[list]]:
    """First and last initial, illegal neighbours and tables of consecutive summaries."""
    loaded = [json.loads(p) for p in parts]
    between = sum(a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(loaded, loaded[1:]))
    return loaded[0][0], loaded[-1][1], sum(x[2] for x in loaded) + between, [x[3] for x in loaded]


@F.pandas_udf(T.StringType())
def _block(turns: pd.Series, initials: pd.Series) -> pd.Series:
    return pd.Series([_summary(t, i) for t, i in zip(turns, initials)], dtype=object)


@F.pandas_udf(T.StringType())
def _join(parts: pd.Series) -> pd.Series:
    def one(blocks) -> str:
        first, last, illegal, tables = _merged(list(blocks))
        return json.dumps([first, last, illegal, combined(tables)])

    return pd.Series([one(p) for p in parts], dtype=object)


@F.pandas_udf(T.StructType().add("cost", T.LongType()).add("audit", T.StringType()).add("illegal", T.LongType()))
def _finish(parts: pd.Series) -> pd.DataFrame:
    rows = []
    for blocks in parts:
        _, _, illegal, tables = _merged(list(blocks))
        rows.append((*answer(tables), illegal))
    return pd.DataFrame(rows, columns=["cost", "audit", "illegal"])


class Repaired(NamedTuple):
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; one row per conversation that has turns.
    conversations: DataFrame
    #: conv_id, position (from 0), edit, role, text of the repaired turns, in order within each partition.
    turns: DataFrame


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def repair(turns: DataFrame) -> Repaired:
    """Faults of the conversations in ``turns`` (conv_id, turn, role, text; other columns are not read) and their repair.

    Turns are in order of turn (nulls first); equal turn numbers go by role and then by the hash of the text, so repeated
    rows are neighbours. A null role or text is one space. Rows without conv_id are one conversation. A turn's first fault
    counts: blank, duplicate (role and text seen earlier), truncated (last visible character is no stop). Texts are whole,
    whatever their length; only hashes and initials are sorted and combined. The repaired turns of a conversation are
    written in order by one task that holds one turn at a time, beside one letter per turn. No rows give no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    order = ["conv_id", "turn", "role", "digest"]
    narrow = stored(rows.select(
        *order, _initial(F.col("role")).alias("initial"), (~F.col("text").rlike(WORD)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut")).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "repair-turns")
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    judged = _numbered(narrow).join(first, "place", "left").select(
        "conv_id", "turn", "at", "initial", "blank", (~F.col("blank") & F.col("first").isNull()).alias("duplicate"), "cut").withColumn(
        "truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("cut"))
    letter = (F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial")))
    blocks = judged.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", letter.alias("letter"), "initial"))).alias("t"),
        *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("low"), F.max("turn").alias("high"))
    blocks = stored(blocks.select("conv_id", "block", "blank", "duplicate", "truncated", "low", "high",
                                  _block(F.array_join("t.letter", ""), F.array_join("t.initial", "")).alias("summary")), "repair-blocks")
    distinct = narrow.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("turn").alias("n"))
    faults = blocks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
                                           F.min("low").alias("low"), F.max("high").alias("high"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).cast("long")
    found = stored(_per_conversation(blocks.select("conv_id", "block", "summary")), "repair-audits")
    conversations = _same_conversation(_same_conversation(found, faults), distinct).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repaired(conversations, _applied(rows, found))


def _same_conversation(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("conv_id", "__conv")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")


def _numbered(narrow: DataFrame) -> DataFrame:
    """``at``: the gapless number of a row in the order in which the rows were stored. The table of offsets has one row per
    partition that wrote rows."""
    part = F.shiftright("place", 33)
    sizes = sorted((r.part, r.n) for r in narrow.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total - (p << 33)))
        total += n
    table = narrow.sparkSession.createDataFrame(offsets, "part long, shift long")
    return narrow.join(F.broadcast(table), part == F.col("part")).withColumn("at", F.col("place") + F.col("shift")).drop("part", "shift")


def _per_conversation(blocks: DataFrame) -> DataFrame:
    """conv_id, cost, audit, illegal. Blocks of long conversations are combined level by level, FAN consecutive ones at once."""
    def most(df: DataFrame) -> int:
        return df.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0

    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "summary"))), lambda x: x["summary"]).alias("parts")
    while most(blocks) > FAN:
        grouped = blocks.groupBy("conv_id", F.floor(F.col("block") / FAN).alias("block")).agg(parts)
        blocks = stored(grouped.select("conv_id", "block", _join("parts").alias("summary")), "repair-level")
    return blocks.groupBy("conv_id").agg(parts).select("conv_id", _finish("parts").alias("f")).select("conv_id", "f.*")


def _applied(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns. Audits and turns of a conversation come to one task, the audit first, and are read as a stream."""
    order = ["turn", "role", "digest"]
    audits = found.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order],
                          F.col("audit").alias("text"))
    every = audits.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), *order, "text"))
    sorted_rows = every.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order).select("conv_id", "kind", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, audit, k, state, position = None, "", 0, 0, 0

        def emit(edit: str, role: str | None, text: str) -> None:
            nonlocal state, position
            name = role if edit == KEEP else NAMES["a" if state == 2 else "u"]
            state = STEP[state, name[:1]]
            out.append((conv, position, edit, name, text))
            position += 1

        def inserts() -> None:
            nonlocal k
            while k < len(audit) and audit[k] == INSERT:
                emit(INSERT, None, "")
                k += 1

        def batch_of(rows_out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows_out), schema)], schema=schema)

        for batch in batches:
            for conv_id, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    conv, audit, k, state, position = conv_id, text, 0, 0, 0
                    inserts()
                    continue
                edit, k = audit[k], k + 1
                if edit != DELETE:
                    emit(edit, role, text)
                inserts()
            if out:
                yield batch_of(out)
                out = []

    return sorted_rows.mapInArrow(run, "conv_id long, position long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, the hash of the ``role:text`` of its turns, joined by line ends.

    ``turns`` is the frame of :func:`repair` itself, whose partitions hold whole conversations in order. A hash is a chain
    over the whole text, so a conversation is read by one task, one turn at a time.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain, begun = None, None, False
        for batch in batches:
            ids, done = [], []
            for conv_id, position, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if position == 0:
                    if begun:
                        ids.append(conv)
                        done.append(chain.hexdigest())
                    conv, chain, begun = conv_id, hashlib.sha256(), True
                else:
                    chain.update(b"\n")
                chain.update(f"{role}:{text}".encode())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(done, pa.string())], schema=schema)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([chain.hexdigest()], pa.string())], schema=schema)

    return turns.mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the hash of conv_id and turn (nulls: one space): a row is dropped, emptied, loses
    its stops, is repeated or gets the role user; conv_id, turn, role, text."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy")).drop("copy")
