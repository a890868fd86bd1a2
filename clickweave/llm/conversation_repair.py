"""Conversation structure repair: the cheapest edits that give the roles system? (user assistant)+.

The edits of a run of messages are paths of a lattice: a node is (messages
read, state), the state being the last role written. Bidirectional Dijkstra
looks for the cheapest paths: a forward heap from the entry and a reverse heap
from the exits meet, go on until every crossing of the least cost is known,
and the least audit (the edits' initials) among the crossings wins.

Conversations are cut into blocks of at most ``BLOCK_ROWS`` messages and
``BLOCK_CHARS`` code points. A conversation in one block is solved at once.
One that spans blocks (or Spark partitions) gets, for every entry and exit
state of every block, the cheapest edits; a walk over its blocks then picks the
states between them. So no task holds more than a block's messages, however
long a conversation is; its result row holds its audit, one letter an edit.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import NULL_KEY, Scratch, key_of

START, SYSTEM, USER, ASSISTANT = range(4)  # nothing written yet, or the last role written
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FIT, BLANK, DUPLICATE, CUT_OFF = range(4)  # a message's fault
GOALS = (START, ASSISTANT)
BLOCK_ROWS, BLOCK_CHARS = 512, 1 << 20
FIRST_TURN = -(2**63)  # stands for a null turn in orders: before every other
_NEXT = (USER, USER, ASSISTANT, USER)  # the role that an insertion or a new role writes, by state
_BEFORE = tuple(tuple(b for b in range(4) if _NEXT[b] == state) for state in range(4))
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_INSIDE = re.compile(r"[^\x20\x09-\x0D]")


Message = tuple[str, int]  # initial of the role, fault


def cheapest(messages: Sequence[Message], entry: int = START, exits: Sequence[int] = GOALS) -> tuple[int, str] | None:
    """Least cost and, among the cheapest edit sequences, the least audit from ``entry`` to one of ``exits``; None if there is none."""
    n = len(messages)

    def onward(node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, state = node
        yield "I", INSERT, (i, _NEXT[state])
        if i < n:
            role, fault = messages[i]
            yield "D", DELETE, (i + 1, state)
            if fault in (FIT, CUT_OFF):
                more = TRUNCATED if fault == CUT_OFF else 0
                if role in _KEPT[state]:
                    yield "K", KEEP + more, (i + 1, _KEPT[state][role])
                yield "R", REROLE + more, (i + 1, _NEXT[state])

    def backward(node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, state = node
        for before in _BEFORE[state]:
            yield "I", INSERT, (i, before)
        if i:
            role, fault = messages[i - 1]
            yield "D", DELETE, (i - 1, state)
            if fault in (FIT, CUT_OFF):
                more = TRUNCATED if fault == CUT_OFF else 0
                for before in range(4):
                    if _KEPT[before].get(role) == state:
                        yield "K", KEEP + more, (i - 1, before)
                for before in _BEFORE[state]:
                    yield "R", REROLE + more, (i - 1, before)

    # forward labels are (cost, audit): appending a letter makes both greater, so a popped label is final
    start = (0, entry)
    ahead: dict[tuple[int, int], tuple[int, str]] = {start: (0, "")}
    settled: set[tuple[int, int]] = set()
    heap = [(0, "", start)]
    # reverse labels are (cost, first letter, next node): edges of a node differ in their letters, so the letter decides ties
    behind: dict[tuple[int, int], tuple[int, str, tuple[int, int] | None]] = {(n, x): (0, "", None) for x in exits}
    closed: set[tuple[int, int]] = set()
    reverse = [(0, (n, x)) for x in sorted(exits)]
    best: int | None = None

    def forward_step() -> None:
        nonlocal best
        cost, audit, node = heapq.heappop(heap)
        if node in settled:
            return
        settled.add(node)
        if node in behind:
            best = min(cost + behind[node][0], cost + behind[node][0] if best is None else best)
        for letter, price, to in onward(node):
            label = (cost + price, audit + letter)
            if to not in ahead or label < ahead[to]:
                ahead[to] = label
                heapq.heappush(heap, (*label, to))

    def reverse_step() -> None:
        nonlocal best
        cost, node = heapq.heappop(reverse)
        if node in closed:
            return
        closed.add(node)
        if node in ahead:
            best = min(cost + ahead[node][0], cost + ahead[node][0] if best is None else best)
        for letter, price, to in backward(node):
            if to not in behind or cost + price < behind[to][0]:
                behind[to] = (cost + price, letter, node)
                heapq.heappush(reverse, (cost + price, to))
            elif (cost + price, letter) < behind[to][:2]:  # over a free edge a tie may come after the node was closed
                behind[to] = (cost + price, letter, node)

    # the ends are settled first, so every cheapest path has a settled node whose next one is closed
    forward_step()
    for _ in exits:
        reverse_step()
    while heap and reverse and (best is None or heap[0][0] + reverse[0][0] <= best):
        if heap[0][0] <= reverse[0][0]:
            forward_step()
        else:
            reverse_step()
    if best is None:
        return None

    def suffix(node: tuple[int, int] | None) -> str:
        letters = []
        while node is not None:
            _, letter, node = behind[node]
            letters.append(letter)
        return "".join(letters)

    found = [ahead[x][1] + suffix(x) for x in settled & closed if ahead[x][0] + behind[x][0] == best]
    for node in settled:
        cost, audit = ahead[node]
        found += [audit + letter + suffix(to) for letter, price, to in onward(node) if to in closed and cost + price + behind[to][0] == best]
    return best, min(found)


def apply_audit(audit: str, roles: Sequence[str], texts: Sequence[str], state: int = START) -> list[tuple[str, str]]:
    """The messages that an audit makes of some messages, from a state on."""
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            out.append((_NAMES[state], ""))
            continue
        if letter == "K":
            state = _KEPT[state][roles[i][:1]]
            out.append((roles[i], texts[i]))
        elif letter == "R":
            state = _NEXT[state]
            out.append((_NAMES[state], texts[i]))
        i += 1
    return out


def damage(rows: DataFrame, dice: Column) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the fault that ``dice`` (0 to 19) names; null roles and texts are one space.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", one_space("role").alias("role"), one_space("text").alias("text"), dice.alias("_dice")).where("_dice <> 0")
    rows = rows.withColumn("_copy", F.explode(F.when(F.col("_dice") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("_dice") == 1, "").when(F.col("_dice") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("_dice") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def turn_dice(sides: int = 20) -> Column:
    """crc32 of ``conv_id:turn`` (nulls: one space), modulo ``sides``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % sides


_PIECE = ("key long, part int, seq int, whole boolean, roles array<string>, texts array<string>, first_turn long, last_turn long, turns long, "
          "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
          "ways array<struct<entry:int,exit:int,cost:long,audit:string>>")
_WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_LEGAL = {"su", "ua", "au"}


class _Block:
    """Messages of one conversation that follow each other."""

    def __init__(self, key: int, seq: int) -> None:
        self.key, self.seq, self.chars = key, seq, 0
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.faults: list[int] = []

    def add(self, role: str, text: str, turn: int | None, repeated: bool) -> None:
        inside = _INSIDE.findall(text[-64:]) or _INSIDE.findall(text)
        fault = BLANK if not inside else DUPLICATE if repeated else CUT_OFF if inside[-1] not in ".!?" else FIT
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.faults.append(fault)
        self.chars += len(text) + len(role)

    def full(self, rows: int, chars: int) -> bool:
        return len(self.roles) >= rows or self.chars >= chars

    def row(self, part: int, begins: bool, ends: bool) -> dict:
        """Piece row; ``begins`` and ``ends`` say that the conversation surely begins and ends with this block."""
        initials = [r[:1] for r in self.roles]
        messages = list(zip(initials, self.faults))
        known = [t for t in self.turns if t is not None]
        ways = []
        if begins and ends:
            cost, audit = cheapest(messages)
            ways = [{"entry": START, "exit": START, "cost": cost, "audit": audit}]
        else:
            for entry in [START] if begins else range(4):
                for leave in GOALS if ends else range(4):
                    way = cheapest(messages, entry, [leave])
                    if way is not None:
                        ways.append({"entry": entry, "exit": leave, "cost": way[0], "audit": way[1]})
        return {
            "key": self.key, "part": part, "seq": self.seq, "whole": begins and ends, "roles": self.roles, "texts": self.texts,
            "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None, "turns": len(set(known)),
            "blank": self.faults.count(BLANK), "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(CUT_OFF),
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
            "first_role": initials[0], "last_role": initials[-1], "ways": ways}


_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 7, pa.string(), pa.string(), _WAYS]


_COLUMNS = ["key", "part", "seq", "whole", "roles", "texts", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal",
            "first_role", "last_role", "ways"]
_PIECES = pa.schema(list(zip(_COLUMNS, _TYPES)))


def _pieces(block_rows: int, block_chars: int):
    """Blocks of a partition whose rows stand in order of (key, turn, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block: _Block | None = None
        before, seen, ready, held = None, 0, [], 0  # keys come in order, so a new key means that the last one is complete

        def put(done: _Block, ends: bool) -> None:
            nonlocal held
            # a partition's first and last conversations may go on in its neighbours
            ready.append(done.row(part, done.seq == 0 and seen > 1, ends))
            held += done.chars

        for batch in batches:
            for key, turn, role, text, digest, first in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if block is None or block.key != key:
                    if block is not None:
                        put(block, True)
                    block, before, seen = _Block(key, 0), None, seen + 1
                elif block.full(block_rows, block_chars):
                    put(block, False)
                    block = _Block(key, block.seq + 1)
                order = FIRST_TURN if turn is None else turn
                block.add(role, text, turn, before == (order, digest) or (first is not None and order != first))
                before = (order, digest)
                if held > block_chars or len(ready) > 1024:
                    yield pa.RecordBatch.from_pylist(ready, _PIECES)
                    ready, held = [], 0
        if block is not None:
            put(block, False)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, _PIECES)
    return run


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """Picks each block's entry and edits for one conversation of several blocks, and what its borders add."""
    pieces = pieces.sort_values(["part", "seq"])
    labels = {START: (0, "", None)}  # state: cost, audit so far, (label before, entry, way)
    for ways in pieces["ways"]:
        new: dict[int, tuple] = {}
        for way in ways:
            if way["entry"] in labels:
                cost, audit, _ = labels[way["entry"]]
                label = (cost + way["cost"], audit + way["audit"])
                if way["exit"] not in new or label < new[way["exit"]][:2]:
                    new[way["exit"]] = (*label, (labels[way["entry"]], way))
        labels = new
    last = min((labels[s] for s in GOALS if s in labels), key=lambda x: x[:2])
    chosen = []
    while last[2] is not None:
        last, way = last[2]
        chosen.append(way)
    chosen.reverse()
    out = pieces[["key", "part", "seq"]].copy()
    out["entry"], out["audit"], out["cost"] = ([w[n] for w in chosen] for n in ("entry", "audit", "cost"))
    illegal, shared, role, turn = [], [], None, None
    for first_role, last_role, first_turn, last_turn in pieces[["first_role", "last_role", "first_turn", "last_turn"]].itertuples(index=False):
        illegal.append(int(role is not None and role + first_role not in _LEGAL))
        shared.append(int(turn is not None and not pd.isna(first_turn) and first_turn == turn))
        role, turn = last_role, None if pd.isna(last_turn) else last_turn
    out["more_illegal"], out["shared_turns"] = illegal, shared
    return out


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            rows = batch.slice(lo, 64)
            entry, audit, roles, texts = (rows.column(i).to_pylist() for i in range(4))
            made = [[{"role": r, "text": t} for r, t in apply_audit(a, rs, ts, e)] for e, a, rs, ts in zip(entry, audit, roles, texts)]
            yield pa.RecordBatch.from_arrays([*rows.columns[4:], rows.column(1), pa.array(made, message)],
                                             [*rows.schema.names[4:], "audit", "messages"])


_STATS = ["first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Repaired pieces of the conversations in ``rows`` (conv_id, turn, role, text).

    One row per block: (key, part, seq, whole, first_turn, last_turn, turns,
    blank, duplicate, truncated, illegal, cost, audit, messages), ``messages``
    being the block's repaired (role, text) in order; a conversation's blocks
    follow each other by (part, seq) and their numbers add up. ``key`` is the
    conv_id (NULL_KEY for null, whose rows form one conversation). Messages
    stand by turn, nulls first, then by a digest of role and text; null roles
    and texts count as one space. Every message takes part: repeated rows are
    duplicates. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "repair")
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(key_of("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"), one_space("role").alias("role"),
                       one_space("text").alias("text"))
    rows = rows.withColumns({"order": F.coalesce("turn", F.lit(FIRST_TURN)), "digest": F.md5(F.concat(F.md5("role"), "text"))})
    # messages that stand at several turns of a conversation: all but the first are repeats; written, so that the join knows their size
    repeats = rows.groupBy("key", "digest").agg(F.min("order").alias("first"), F.max("order").alias("_last")).where("first <> _last").drop("_last")
    marked = rows.join(scratch.table(repeats, "repeats"), ["key", "digest"], "left")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = marked.repartitionByRange(parts, "key", "order", "digest").sortWithinPartitions("key", "order", "digest")
    pieces = scratch.table(sorted_rows.select("key", "turn", "role", "text", "digest", "first").mapInArrow(_pieces(block_rows, block_chars), _PIECE), "pieces")
    chosen = pieces.where("NOT whole").drop("roles", "texts").groupBy("key").applyInPandas(
        _chain, "key long, part int, seq int, entry int, audit string, cost long, more_illegal long, shared_turns long")
    chosen = scratch.table(chosen, "chosen")
    way = F.col("ways")[0]
    kept = ["key", "part", "seq", "whole", *_STATS]
    done = pieces.where("whole").select(way["entry"].alias("entry"), way["audit"].alias("audit"), "roles", "texts",
                                        *[c for c in kept if c != "cost"], way["cost"].alias("cost"))
    split = pieces.where("NOT whole").join(chosen, ["key", "part", "seq"]).withColumns(
        {"illegal": F.col("illegal") + F.col("more_illegal"), "turns": F.col("turns") - F.col("shared_turns")})
    both = done.unionByName(split.select(*done.columns))
    types = {"whole": "boolean", "part": "int", "seq": "int"}
    schema = ", ".join(f"{c} {types.get(c, 'long')}" for c in kept)
    out = scratch.table(both.select("entry", "audit", "roles", "texts", *kept).mapInArrow(
        _repaired, f"{schema}, audit string, messages array<struct<role:string,text:string>>"), "repaired")
    scratch.drop("repeats", "pieces", "chosen")
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the lines of each key, from rows in order of (key, part, seq); one line is held at a time."""
    key, state, some = None, None, False
    out: list[tuple[int, str]] = []
    for batch in batches:
        for k, lines in zip(batch.column(0).to_pylist(), batch.column(1)):
            if k != key:
                if key is not None:
                    out.append((key, state.hexdigest()))
                key, state, some = k, hashlib.sha256(), False
            for line in lines.values if lines.is_valid else ():
                state.update((b"\n" if some else b"") + (line.as_py() or "").encode())
                some = True
    if key is not None:
        out.append((key, state.hexdigest()))
    if out:
        keys, hashes = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hashes)], ["key", "sha256"])


def conversation_report(original: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conv_id of ``original``: counts, gaps, cost, audit and the sha256 of the repaired ``role:text`` lines.

    ``pieces`` comes from ``repair``. A conversation without pieces has zeros,
    an empty audit and the hash of the empty string. Conversations in one
    piece are hashed where they are; those in several are sorted and hashed as
    a stream, so none is held whole.
    """
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    stats = [F.min("first_turn").alias("low"), F.max("last_turn").alias("high"), *[F.sum(c).alias(c) for c in _STATS[2:]]]
    whole = pieces.where("whole").select("key", F.col("first_turn").alias("low"), F.col("last_turn").alias("high"), *_STATS[2:], "audit",
                                         F.sha2(F.concat_ws("\n", lines), 256).alias("repaired_sha256"))
    split = pieces.where("NOT whole")
    audit = F.array_sort(F.collect_list(F.struct("part", "seq", "audit")))
    told = split.groupBy("key").agg(*stats, F.array_join(F.transform(audit, lambda a: a["audit"]), "").alias("audit"))
    hashes = split.select("key", "part", "seq", lines.alias("lines")).repartition("key").sortWithinPartitions("key", "part", "seq").select(
        "key", "lines").mapInArrow(_digests, "key long, sha256 string")
    told = told.join(hashes, "key").withColumnRenamed("sha256", "repaired_sha256")
    found = whole.unionByName(told.select(*whole.columns))
    every = original.select(key_of("conv_id").alias("key")).distinct()
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("blank", "duplicate", "truncated", "illegal", "cost")}
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return every.join(found, "key", "left").select(
        F.when(F.col("key") != NULL_KEY, F.col("key")).alias("conv_id"), gaps.alias("gaps"), *[c.alias(n) for n, c in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
