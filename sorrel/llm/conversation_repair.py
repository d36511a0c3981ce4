"""Repair of conversation structure by a dynamic program over a secondary-sorted stream.

Rows are repartitioned by conversation and sorted by turn, and a task reads them as a stream of Arrow
batches (the generator of ``mapInPandas``, here ``mapInArrow``, so that 64-bit turns with nulls stay whole).
A repaired conversation has the role initials ``(s?(ua)+)?``, which is an automaton of four states:
nothing yet, after the system row, after a user row, after an assistant row. The program carries from
row to row, and so from batch to batch,

* the cost of the cheapest edits that lead to each state, less the least of them,
* the order of the states by the text of these edits, which settles ties,
* a running SHA-256 of the repaired rows per state, so that no text is kept.

Two cheapest edit texts of one row and different states never begin one another, as each ends with the
letter of that row; so their order decides whatever follows. Few such (cost, order) pairs occur, and
each step from one to the next is worked out once per task. Four bytes a row point back to the best
predecessor of each state; they are kept in blocks, which a giant conversation spills to a file of the
task's own, gone when the task ends. At the end of the conversation the edits are read off backwards.

Whether a row's role and text occurred at an earlier turn is found before, by a window over digests, and
comes into the stream as *marks* in front of the rows of the turn concerned. So a task holds no
set of texts, and a conversation of any length takes memory only for its edits.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: b"user:", ASSISTANT: b"assistant:"}
LETTERS = "DIKR"
#: What an inserted or renamed row becomes after each state.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
#: Bytes of pointers gathered before they join the spool, and bytes of the spool kept in memory.
BLOCK, SPOOL = 1 << 16, 16 << 20
LONG = 2**63 - 1
START = ((0, None, None, None), (EMPTY,))

HEAD, MARK, ROW = 0, 1, 2
SCHEMA = (
    "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _kept(state: int, initial: str) -> int | None:
    """The state after a row of this role initial, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _inserted(state: int, times: int) -> int:
    for _ in range(times):
        state = NEXT[state]
    return state


def step(costs: tuple, order: tuple, initial: str, must_go: bool, truncated: bool) -> tuple:
    """One row on: new costs and order, what to add to all costs, and by state its pointer or None.

    ``costs`` has the cost by state or None, ``order`` the states from the least edit text up. A
    pointer is (state before, inserts, letter).
    """
    best: dict[int, tuple] = {}
    for rank, state in enumerate(order):
        for inserts in range(3):
            at, paid = _inserted(state, inserts), costs[state] + INSERT * inserts
            choices = [("D", at, paid + DELETE)]
            if not must_go:
                paid += TRUNCATED * truncated
                choices.append(("R", NEXT[at], paid + REROLE))
                if (to := _kept(at, initial)) is not None:
                    choices.append(("K", to, paid))
            for letter, to, cost in choices:
                found = (cost, rank, "I" * inserts + letter, state, inserts, letter)
                if to not in best or found < best[to]:
                    best[to] = found
    # A state that inserts reach for less from another one is in no cheapest edit.
    for state in list(best):
        if any(_inserted(o, n) == state and best[o][0] + INSERT * n < best[state][0] for o in best for n in (1, 2)):
            best.pop(state)
    least = min(x[0] for x in best.values())
    new_costs = tuple(best[s][0] - least if s in best else None for s in range(4))
    new_order = tuple(sorted(best, key=lambda s: best[s][1:3]))
    return new_costs, new_order, least, tuple(best[s][3:] if s in best else None for s in range(4))


def last_inserts(costs: tuple, order: tuple) -> tuple[int, int, int]:
    """State and number of inserts that end a conversation at the least cost, and what they add."""
    ends = []
    for rank, state in enumerate(order):
        for inserts in range(3):
            at = _inserted(state, inserts)
            if at == ASSISTANT or (at == EMPTY and not inserts):
                ends.append((costs[state] + INSERT * inserts, rank, "I" * inserts, state, inserts))
    cost, _, _, state, inserts = min(ends)
    return state, inserts, cost


class Steps:
    """The steps met so far, each worked out once, with their pointers packed to a byte per state."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def of(self, at: tuple, kind: tuple) -> tuple:
        found = self.known.get((at, kind))
        if found is None:
            costs, order, added, moves = step(*at, *kind)
            packed = bytes(255 if m is None else m[0] | m[1] << 2 | LETTERS.index(m[2]) << 4 for m in moves)
            found = self.known[at, kind] = (costs, order), added, [(s, *m) for s, m in enumerate(moves) if m], packed
        return found


class Conversation:
    """What the stream carries of the conversation it is in."""

    def __init__(self, steps: Steps):
        self.steps, self.at, self.cost = steps, START, 0
        self.digests = {EMPTY: hashlib.sha256()}
        self.block, self.spool, self.rows = bytearray(), None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns = 0
        self.turn, self.marks, self.before, self.initial = None, set(), None, None

    def mark(self, turn: int | None, digest: bytes) -> None:
        self._enter(turn)
        self.marks.add(digest)

    def _enter(self, turn: int | None) -> None:
        if turn != self.turn:
            self.turn, self.marks = turn, set()

    def row(self, turn: int | None, role: str, text: str) -> None:
        self._enter(turn)
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        if self.rows:
            self.illegal += self.initial + initial not in LEGAL
        self.initial = initial
        stripped = text.rstrip(BLANKS)
        now, same = (turn, role, text), False
        if stripped:
            # Equal rows of one turn stand side by side; those of earlier turns are marked.
            same = now == self.before or (bool(self.marks) and digest_of(role, text) in self.marks)
        self.before = now
        cut = bool(stripped) and not same and stripped[-1] not in ENDS
        self.blank += not stripped
        self.duplicate += same
        self.truncated += cut
        self._move((initial if initial in ("s", "u", "a") else "", not stripped or same, cut), role, text)

    def _move(self, kind: tuple, role: str, text: str) -> None:
        self.at, added, moves, packed = self.steps.of(self.at, kind)
        self.cost += added
        self.rows += 1
        digests, said = {}, text.encode("utf-8", "surrogatepass")
        for to, state, inserts, letter in moves:
            digest = self.digests[state]
            if inserts or letter != "D":
                digest = digest.copy()
                state = _write_inserts(digest, state, inserts)
                if letter != "D":
                    digest.update(b"\n" if state != EMPTY else b"")
                    digest.update(NAMES[to] if letter == "R" else role.encode("utf-8", "surrogatepass") + b":")
                    digest.update(said)
            digests[to] = digest
        self.digests = digests
        self.block += packed
        if len(self.block) >= BLOCK:
            if self.spool is None:
                self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL)
            self.spool.write(self.block)
            self.block = bytearray()

    def _blocks_backwards(self) -> Iterator[bytes]:
        yield bytes(self.block)
        if self.spool is not None:
            for start in range(self.spool.tell() - BLOCK, -1, -BLOCK):
                self.spool.seek(start)
                yield self.spool.read(BLOCK)
            self.spool.close()

    def result(self) -> tuple:
        state, inserts, added = last_inserts(*self.at)
        digest = self.digests[state].copy()
        _write_inserts(digest, state, inserts)
        audit = ["I" * inserts]
        for block in self._blocks_backwards():
            for start in range(len(block) - 4, -1, -4):
                move = block[start + state]
                state = move & 3
                audit.append("I" * (move >> 2 & 3) + LETTERS[move >> 4])
        gaps = 0 if self.low is None else min(LONG, self.high - self.low + 1 - self.turns)
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + added, "".join(reversed(audit)),
                digest.hexdigest())


def _write_inserts(digest, state: int, inserts: int) -> int:
    for _ in range(inserts):
        digest.update((b"\n" if state != EMPTY else b"") + NAMES[NEXT[state]])
        state = NEXT[state]
    return state


def digest_of(role: str, text: str) -> bytes:
    one = role.encode("utf-8", "surrogatepass")
    return hashlib.md5(str(len(one)).encode() + b":" + one + text.encode("utf-8", "surrogatepass")).digest()


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def _repair(schema: pa.Schema):
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, key = Steps(), None, None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "role", "text", "digest"))
            for conv_id, turn, kind, role, text, digest in zip(*columns):
                # Every conversation begins with its head, so that one without rows has a result.
                if kind == HEAD:
                    if now is not None:
                        done.append((key, *now.result()))
                    now, key = Conversation(steps), conv_id
                elif kind == MARK:
                    now.mark(turn, digest)
                else:
                    now.row(turn, role, text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], names=names)
        if now is not None:
            last = (key, *now.result())
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, schema.types)], names=names)

    return run


def damage(rows: DataFrame) -> DataFrame:
    """Rows with a null as one space in ``role`` and ``text``, damaged by a hash of conversation and turn.

    Of 20 hash values 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row and
    4 makes its role ``user``.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), part("role").alias("role"), part("text").alias("text"),
                        what.alias("what"))
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("what") == 3, 2).otherwise(1)
    return plain.where("what <> 0").select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    ).drop("_copy")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every conversation.

    ``rows`` has ``conv_id, turn, role, text``, ``conversations`` further ``conv_id`` values that get a result
    even without rows. Rows go by turn, nulls first, and rows of one turn by role and text. Returns per
    conversation ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` as the module
    and the letters of ``audit`` say: D deletes a row, I inserts one without text, K keeps, R renames.

    A null role or text counts as one space, and rows with a null ``conv_id`` are one conversation. Long
    texts are hashed as they pass. Repeated rows are duplicates; further columns do not matter. An empty
    table gives an empty result. The rows of one conversation go through one task in order, as the digest
    of a repaired conversation runs from its first row to its last.
    """
    spark = rows.sparkSession
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), part("role"), part("text"))
    known = plain.select("conv_id") if conversations is None else conversations.select("conv_id").union(plain.select("conv_id"))
    heads = known.distinct().withColumn("kind", F.lit(HEAD))
    nth = F.dense_rank().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first()))
    digests = plain.select("conv_id", "turn", _digest(F.col("role"), F.col("text")).alias("digest"))
    marks = digests.withColumn("nth", nth).where("nth > 1").select("conv_id", "turn", "digest").distinct()
    stream = plain.withColumn("kind", F.lit(ROW)).unionByName(
        marks.withColumn("kind", F.lit(MARK)), allowMissingColumns=True
    ).unionByName(heads, allowMissingColumns=True)
    # A head stands before all turns, a mark before the rows of its turn.
    sort = [F.col("conv_id"), F.col("kind") != HEAD, F.col("turn").asc_nulls_first(), "kind", "role", "text"]
    dealt = stream.repartition(shuffle_partitions(spark), "conv_id").sortWithinPartitions(*sort)
    schema = SCHEMA.format(kind=rows.schema["conv_id"].dataType.simpleString())
    columns = ["conv_id", "turn", "kind", "role", "text", "digest"]
    empty = spark.createDataFrame([], schema)
    arrow = empty.toArrow().schema
    return stored(dealt.select(columns).mapInArrow(_repair(arrow), schema))
