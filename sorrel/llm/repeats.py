"""Repeated stretches across a corpus: the parts that both substring operators share.

A *unit* is a byte or a word, a *window* is ``length`` consecutive units of one text. Every
window holds an *anchor*, a run of ``gram``
units whose hash is least within the window, so equal windows hold equal anchors in the same
place. Only anchors travel, packed into arrays and addressed to groups of bounded size:

* an anchor whose run occurs once in the corpus settles that its windows do not repeat;
* the *context* of an anchor holds all windows around it. Where an earlier text has the same
  context, all those windows are repeats and are settled too;
* of the other windows with an anchor, one half holds more of what stands before the run
  and one more of what stands after it. Where no other text has the run with that much
  before it, or after it, that half does not repeat either;
* the windows that are left, near the ends of copied passages, are *open*.

Of equal (run, context) pairs a batch sends on the first only, so a passage that sits in a
third of all texts costs a row per batch and not per text; a run that stands in many
contexts within one batch is open there, and one row bears witness. The operators settle the open
windows, each by its own method, and mark what they cover.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import bound_rows, shuffle_partitions, stored
from sorrel.llm.tokens import BASES, U, Powers, Sums, mix, word_bounds, word_hashes, word_hashes_of

#: Bytes of text whose equal rows are combined inside a task, and of a group.
BATCH, GROUP = 2 << 20, 16 << 20
#: Bytes of a batch that are hashed at a time; working memory is some 100 times this.
PIECE = 256 << 10
#: Contexts of a run in one batch above which they are not sent on one by one.
COMMON = 64


@dataclass(frozen=True)
class Unit:
    """Units are words or bytes. ``own`` says whether a text also repeats what it held earlier itself."""

    words: bool
    length: int
    gram: int
    own: bool

    @property
    def before(self) -> int:
        """Units before the run that a window of the first half holds at least."""
        return (self.length - self.gram + 1) // 2

    @property
    def after(self) -> int:
        """Units after the run that a window of the other half holds at least."""
        return self.length - self.gram - self.before + 1

    def values(self, text: bytes) -> np.ndarray:
        return word_hashes(text) if self.words else np.frombuffer(text, dtype=np.uint8)


@dataclass
class Batch:
    """Some texts as one array of units, and where each of them lies.

    Its running sums take far more room than the texts, so texts come in small batches, the pieces of a larger one.
    """

    unit: Unit
    ids: np.ndarray
    checks: np.ndarray
    texts: list[bytes]
    powers: Powers
    values: np.ndarray = field(init=False)
    ends: np.ndarray = field(init=False)
    kept: dict[int, Sums] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        if not self.texts:
            self.values, counts = np.zeros(0, U), []
        elif self.unit.words:
            self.values, counts = word_hashes_of(self.texts, self.powers)
        else:
            self.values, counts = np.frombuffer(b"".join(self.texts), np.uint8), [len(t) for t in self.texts]
        self.ends = np.cumsum([0, *counts])

    def sums(self, base: np.uint64 = BASES[0]) -> Sums:
        """The running sums under a base, worked out once for all stretches of the batch."""
        if int(base) not in self.kept:
            self.kept[int(base)] = Sums(self.values, base, self.powers)
        return self.kept[int(base)]

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right") - 1

    def context(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretch around each anchor that holds all windows with it."""
        doc, spare = self.owner(at), self.unit.length - self.unit.gram
        return np.maximum(self.ends[doc], at - spare), np.minimum(self.ends[doc + 1], at + self.unit.length)


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value among every ``width`` consecutive ones, by doubling."""
    least, place, reach = values, np.arange(len(values), dtype=np.int32), 1
    while reach < width:
        by = min(reach, width - reach)
        later = least[by:] < least[:-by]
        least, place = np.where(later, least[by:], least[:-by]), np.where(later, place[by:], place[:-by])
        reach += by
    return place


def windows_and_anchors(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the anchor of each, and the hashes of the runs by position."""
    unit, n = batch.unit, len(batch.values)
    if n < unit.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    run = batch.sums().every(unit.gram)
    whole = np.ones(n - unit.length + 1, bool)
    for end in batch.ends[1:-1].tolist():
        # Windows that begin here would reach over the end of a text.
        whole[max(0, end - unit.length + 1) : end] = False
    windows = np.flatnonzero(whole)
    return windows, least_places(run, unit.length - unit.gram + 1)[windows], run


def anchors(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all anchors and the hashes of their runs."""
    _, places, run = windows_and_anchors(batch)
    chosen = np.zeros(len(run), bool)
    chosen[places] = True
    at = np.flatnonzero(chosen)
    return at, run[at]


def firsts(columns: list[np.ndarray], ids: np.ndarray, at: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by columns, id and position; run numbers; and which rows repeat an earlier one of their run."""
    order = np.lexsort([at, ids, *columns[::-1]])
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = False
        for c in columns:
            fresh[1:] |= c[order][1:] != c[order][:-1]
    return order, np.cumsum(fresh) - 1, later_rows(ids[order], at[order], fresh, own)


def later_rows(ids: np.ndarray, at: np.ndarray, fresh: np.ndarray, own: bool) -> np.ndarray:
    """By row, in order: whether the run of equal rows that begins at ``fresh`` has an earlier one.

    A row that occurs twice, with one id and position, is not earlier than itself.
    """
    if not len(fresh):
        return fresh
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = ids > ids[first]
    return later | ((ids == ids[first]) & (at > at[first])) if own else later


def several(run: np.ndarray, what: np.ndarray) -> np.ndarray:
    """By row, sorted by run: whether ``what`` differs within the run."""
    if not len(run):
        return np.zeros(0, bool)
    start = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    differ = np.minimum.reduceat(what, start) != np.maximum.reduceat(what, start)
    return np.repeat(differ, np.diff(np.append(start, len(run))))


def pack(**columns: np.ndarray) -> dict[str, bytes]:
    return {k: np.ascontiguousarray(v).tobytes() for k, v in columns.items()}


def unpack(frame: pd.DataFrame, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(frame[column]), dtype=kind)


#: Rows of packed arrays, addressed to group ``to``: an id, check and position of the text,
#: and hashes of the run, of the run with what is before or after it (0 if the text is
#: too short for that), and of the context, by two bases. ``settled``: 0 to be settled, 1 a witness only,
#: 2 covered by an earlier text, 3 open, 4 open for windows of the first half, 5 of the other.
#: A text is taken as covered only if its run, sides and 96 bits of its context are those of an earlier one.
PACKED = (
    "to int, ids binary, checks binary, at binary, run binary, left binary, right binary, context binary, more binary, "
    "settled binary"
)
#: The address takes the low bits of a run's hash and the row the high ones; two runs that look
#: alike even so only leave their windows open.
KINDS = {
    "ids": np.int64, "checks": np.int32, "at": np.int32, "run": np.uint32, "left": np.uint32, "right": np.uint32,
    "context": U, "more": np.uint32, "settled": np.int8,
}
#: Findings, addressed to the group of the text.
FOUND = "to int, ids binary, checks binary, at binary, settled binary"


def split(to: np.ndarray, columns: dict[str, np.ndarray], names: list[str]) -> pd.DataFrame:
    """One row of packed arrays per address."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, int)
    rows = [
        {"to": int(to[a]), **pack(**{k: columns[k][order[a:b]].astype(KINDS[k]) for k in names})}
        for a, b in zip(cuts, np.append(cuts[1:], len(to)))
    ]
    return pd.DataFrame(rows, columns=["to", *names])


def homes(ids: np.ndarray, checks: np.ndarray, groups: int) -> np.ndarray:
    """The group of each text, as ``corpus_of`` deals it."""
    return (ids ^ checks.astype(np.int64)) % groups


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Texts in tables of bounded size, each by id."""
    held, size = [], 0
    for part in bound_rows(batches, "text", BATCH):
        held.append(part)
        size += part.column("text").nbytes
        if size >= BATCH:
            yield pa.Table.from_batches(held).select(["doc_id", "check", "text"]).sort_by("doc_id")
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).select(["doc_id", "check", "text"]).sort_by("doc_id")


def pieces(unit: Unit, ids: np.ndarray, checks: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int, Batch]]:
    """The texts in pieces of bounded size, one text at least, with the texts and the units before each piece."""
    start, size, units, kept = 0, 0, 0, Powers()
    for i in range(len(texts)):
        size += len(texts[i])
        if size >= PIECE or i == len(texts) - 1:
            piece = Batch(unit, ids[start : i + 1], checks[start : i + 1], texts[start : i + 1], kept)
            yield start, units, piece
            start, size, units = i + 1, 0, units + len(piece.values)


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([part[k] for part in parts]) for k in parts[0]}


def encoded(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def sides(batch: Batch, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of each run with what is before it and with what is after it; 0 where the text ends."""
    unit = batch.unit
    low, high = batch.ends[doc], batch.ends[doc + 1]
    start, stop = at - unit.before, at + unit.gram + unit.after
    sums = batch.sums(BASES[1])
    left = sums.of(np.maximum(start, low), at + unit.gram) >> U(32) | U(1)
    right = sums.of(at, np.minimum(stop, high)) >> U(32) | U(1)
    return np.where(start >= low, left, U(0)), np.where(stop <= high, right, U(0))


def described(batch: Batch) -> dict[str, np.ndarray]:
    """The anchors of a batch: their place and text, and the hashes of all that is compared."""
    at, runs = anchors(batch)
    lo, hi = batch.context(at)
    doc = batch.owner(at)
    left, right = sides(batch, at, doc)
    return {
        "place": at, "doc": doc, "at": at - batch.ends[doc], "run": runs, "left": left, "right": right,
        "context": batch.sums(BASES[1]).of(lo, hi) ^ mix((at - lo).astype(U)), "more": batch.sums().of(lo, hi),
    }


def _send_anchors(unit: Unit, groups: int):
    names = list(KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_of(batches):
            ids, checks = table.column("doc_id").to_numpy(), table.column("check").to_numpy()
            parts = []
            for docs, units, piece in pieces(unit, ids, checks, encoded(table.column("text").to_pylist())):
                parts.append(described(piece))
                parts[-1]["place"] += units
                parts[-1]["doc"] += docs
            c = joined(parts)
            # Places go up with the ids here, so that a stable order by hashes leaves equal ones by id and place.
            order = np.lexsort([c["context"], c["run"]])
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([c[k][order][1:] != c[k][order][:-1] for k in ("run", "context", "more")], axis=0)
            runs, doc = c["run"][order], c["doc"][order]
            repeat = later_rows(ids[doc], c["place"][order], fresh, unit.own)
            settled = np.where(repeat, 2, 0).astype(np.int8)
            # A run with many contexts in this batch alone is open here; one row bears witness elsewhere.
            unsettled = np.flatnonzero(~repeat)
            numbers = np.cumsum(np.concatenate(([0], runs[1:] != runs[:-1]))) if len(runs) else runs.astype(int)
            many = np.bincount(numbers[unsettled], minlength=1)[numbers[unsettled]] > COMMON
            if not unit.own:
                many &= several(numbers[unsettled], ids[doc[unsettled]])
            settled[unsettled[many]] = 3
            witness = unsettled[many]
            if len(witness):
                witness = witness[np.concatenate(([True], numbers[witness][1:] != numbers[witness][:-1]))]
            rows = order[np.concatenate([np.arange(len(order)), witness])]
            settled = np.concatenate([settled, np.ones(len(witness), np.int8)])
            # In the order of the texts, where neighbouring ids are alike and take little room.
            place = np.argsort(c["place"][rows], kind="stable")
            rows, settled = rows[place], settled[place]
            runs, doc = c["run"][rows], c["doc"][rows]
            columns = {
                "ids": ids[doc], "checks": checks[doc], "at": c["at"][rows], "run": runs >> U(32), "left": c["left"][rows],
                "right": c["right"][rows], "context": c["context"][rows], "more": c["more"][rows] >> U(32), "settled": settled,
            }
            home = homes(columns["ids"], columns["checks"], groups)
            to = np.where(settled >= 2, home, (runs % U(groups)).astype(np.int64))
            frame = split(to, columns, names)
            yield pa.RecordBatch.from_pandas(frame, schema=_arrow(PACKED), preserve_index=False)

    return run


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def shared(runs: np.ndarray, side: np.ndarray, context: np.ndarray, ids: np.ndarray, own: bool) -> np.ndarray:
    """Whether the same run has the same side in another context, of another text unless ``own``."""
    order = np.lexsort([side, runs])
    fresh = np.ones(len(order), bool)
    fresh[1:] = (runs[order][1:] != runs[order][:-1]) | (side[order][1:] != side[order][:-1])
    number = np.cumsum(fresh) - 1
    out = np.zeros(len(order), bool)
    if len(order):
        differs = several(number, context[order])
        out[order] = differs if own else differs & several(number, ids[order])
    return out & (side > 0)


def settle_anchors(frame: pd.DataFrame, unit: Unit, groups: int) -> pd.DataFrame:
    """What the anchors of one group say of each other, addressed to the groups of the texts."""
    c = {k: unpack(frame, k, kind) for k, kind in KINDS.items()}
    done = c["settled"] >= 2
    told = np.flatnonzero(done)
    rest = np.flatnonzero(~done)
    # Equal contexts have equal sides, so that all hashes tell contexts apart.
    sides_ = c["left"][rest].astype(U) << U(32) | c["right"][rest]
    whole = mix(sides_) ^ mix(c["more"][rest].astype(U) << U(32) | c["run"][rest]) ^ c["context"][rest]
    order, _, repeat = firsts([c["run"][rest], whole, c["context"][rest]], c["ids"][rest], c["at"][rest], unit.own)
    rows = rest[order]
    witness = c["settled"][rows] == 1
    runs = c["run"][rows]
    numbers = np.cumsum(np.concatenate(([0], runs[1:] != runs[:-1]))) if len(runs) else runs.astype(int)
    # A witness stands for further contexts, so whatever shares its run is open.
    seen = np.bincount(numbers, witness, numbers[-1] + 1)[numbers] > 0 if len(numbers) else witness
    first, other = (shared(runs, c[side][rows], whole[order], c["ids"][rows], unit.own) for side in ("left", "right"))
    settled = np.select([repeat, seen | (first & other), first, other], [2, 3, 4, 5], 0).astype(np.int8)
    settled[witness] = 0
    keep = settled > 0
    every = np.concatenate([told, rows[keep]])
    columns = {k: c[k][every] for k in ("ids", "checks", "at")}
    columns["settled"] = np.concatenate([c["settled"][told], settled[keep]])
    return split(homes(columns["ids"], columns["checks"], groups), columns, ["ids", "checks", "at", "settled"])


def identity(ids: np.ndarray, checks: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.int64).view(U)) ^ checks.astype(np.int64).view(U)


@dataclass
class Findings:
    """What was found in the texts of a group, in the order of the texts' identities."""

    texts: np.ndarray
    at: np.ndarray
    settled: np.ndarray

    @classmethod
    def of(cls, found: pd.DataFrame) -> Findings:
        if not len(found):
            return cls(np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int8))
        texts = identity(unpack(found, "ids", np.int64), unpack(found, "checks", np.int32))
        order = np.argsort(texts, kind="stable")
        return cls(texts[order], unpack(found, "at", np.int32)[order], unpack(found, "settled", np.int8)[order])


def first_units(batch: Batch, found: Findings) -> tuple[np.ndarray, np.ndarray]:
    """Place in the batch and finding of every finding that concerns one of its texts."""
    own = identity(batch.ids, batch.checks)
    first = np.searchsorted(found.texts, own, "left")
    count = np.searchsorted(found.texts, own, "right") - first
    doc = np.repeat(np.arange(len(own)), count)
    rows = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(doc))
    return batch.ends[doc] + found.at[rows], found.settled[rows]


def marked(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Mask of the positions inside any stretch ``[lo, hi)``."""
    change = np.bincount(lo, minlength=n + 1)[: n + 1] - np.bincount(hi, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


@dataclass
class Corpus:
    """The texts with an id, dealt into groups of bounded size by id and a check of the text."""

    texts: DataFrame
    groups: int


def corpus_of(docs: DataFrame) -> Corpus:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where("doc_id is not null")
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-size // GROUP), 2 * shuffle_partitions(docs.sparkSession))
    check = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    home = F.pmod(F.col("doc_id").bitwiseXOR(F.col("check").cast("long")), F.lit(groups)).cast("int")
    return Corpus(read.withColumn("check", check).withColumn("to", home), groups)


#: What stage two leaves: finished texts, texts that wait for open windows, and those windows.
STAGE = (
    "kind int, to int, doc_id long, check int, times long, n_units long, n_removed long, n_spans long, sha string, "
    "covered binary, text string, ids binary, checks binary, at binary, one binary, two binary, lead binary"
)
DONE, WAITING, WINDOWS = 0, 1, 2
WINDOW_KINDS = {"ids": np.int64, "checks": np.int32, "at": np.int32, "one": U, "two": np.uint32, "lead": U}


def open_windows(batch: Batch, found: Findings) -> tuple[np.ndarray, np.ndarray]:
    """Mask of what is covered already, and the starts of the windows that their anchor leaves open."""
    unit, n = batch.unit, len(batch.values)
    at, settled = first_units(batch, found)
    code = np.zeros(n + 1, np.int8)
    code[at] = settled
    lo, hi = batch.context(at[settled == 2])
    covered = marked(n, lo, hi)
    starts, places, _ = windows_and_anchors(batch)
    state, first = code[places], places - starts >= unit.before
    return covered, starts[(state == 3) | (first & (state == 4)) | (~first & (state == 5))]


def finished(row: tuple, mask: np.ndarray, finish: Callable) -> dict:
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return {
        "kind": DONE, "doc_id": int(row.doc_id), "check": int(row.check), "times": int(row.times), "n_units": len(mask),
        "n_removed": int(mask.sum()), "n_spans": int((edges == 1).sum()), "sha": finish(row.raw, mask),
    }


def text_batches(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The texts of one group in frames of bounded size; rows with equal id and text count once, ``times`` over."""
    keys = ["doc_id", "check"]
    if "times" not in frame:
        frame = frame.assign(times=frame.groupby(keys)["check"].transform("size"))
    frame = frame.drop_duplicates(keys).sort_values(keys, kind="stable")
    frame = frame.assign(raw=encoded(frame["text"]))
    start, size = 0, 0
    for i, text in enumerate(frame["raw"]):
        size += len(text)
        if size >= BATCH or i == len(frame) - 1:
            yield frame.iloc[start : i + 1]
            start, size = i + 1, 0


def pieces_of(part: pd.DataFrame, unit: Unit) -> Iterator[tuple[int, int, Batch]]:
    return pieces(unit, part["doc_id"].to_numpy(), part["check"].to_numpy(), part["raw"].tolist())


def stage_two(texts: pd.DataFrame, found: pd.DataFrame, unit: Unit, address: Callable, finish: Callable) -> pd.DataFrame:
    """Finish the texts of a group that hold no open window and send the open windows of the others."""
    out, told = [], Findings.of(found)
    for part in text_batches(texts):
        ids, checks = part["doc_id"].to_numpy(), part["check"].to_numpy()
        parts, masks, ends = [], [], [np.zeros(1, np.int64)]
        for docs, units, piece in pieces_of(part, unit):
            covered, starts = open_windows(piece, told)
            doc = piece.owner(starts)
            one, two = (piece.sums(base).of(starts, starts + unit.length) for base in BASES)
            to, lead = address(piece, starts, one)
            masks.append(covered)
            ends.append(piece.ends[1:] + units)
            parts.append({
                "place": starts + units, "doc": doc + docs, "at": starts - piece.ends[doc], "one": one, "two": two,
                "lead": lead, "to": to,
            })
        c, covered, ends = joined(parts), np.concatenate(masks), np.concatenate(ends)
        order, _, repeat = firsts([c["one"], c["two"]], ids[c["doc"]], c["place"], unit.own)
        again = c["place"][order[repeat]]
        covered |= marked(len(covered), again, again + unit.length)
        sent = order[~repeat]
        waiting = np.zeros(len(ids), bool)
        waiting[c["doc"][sent]] = True
        for i, row in enumerate(part.itertuples()):
            mask = covered[ends[i] : ends[i + 1]]
            if waiting[i]:
                out.append({
                    "kind": WAITING, "to": int(row.to), "doc_id": int(row.doc_id), "check": int(row.check), "times": int(row.times),
                    "covered": np.packbits(mask).tobytes(), "text": row.text,
                })
            else:
                out.append(finished(row, mask, finish))
        if len(sent):
            doc, to = c["doc"][sent], c["to"][sent]
            columns = {
                "ids": ids[doc], "checks": checks[doc], "at": c["at"][sent],
                "one": c["one"][sent], "two": c["two"][sent] >> U(32), "lead": c["lead"][sent],
            }
            cut = np.argsort(to, kind="stable")
            edge = np.flatnonzero(np.concatenate(([True], to[cut][1:] != to[cut][:-1])))
            for a, b in zip(edge, np.append(edge[1:], len(cut))):
                rows = cut[a:b]
                packed = pack(**{k: columns[k][rows].astype(kind) for k, kind in WINDOW_KINDS.items()})
                out.append({"kind": WINDOWS, "to": int(to[rows[0]]), **packed})
    return _typed(out)


def _typed(out: list[dict]) -> pd.DataFrame:
    kinds = {"int": "Int32", "long": "Int64"}
    return pd.DataFrame({
        name: pd.Series([row.get(name) for row in out], dtype=kinds.get(kind, object))
        for name, kind in (c.split() for c in STAGE.split(", "))
    })


def stage_three(texts: pd.DataFrame, found: pd.DataFrame, unit: Unit, finish: Callable) -> pd.DataFrame:
    """Finish the texts that waited, with what was found of their open windows."""
    out, told = [], Findings.of(found)
    for part in text_batches(texts):
        rows = part.itertuples()
        for _, _, piece in pieces_of(part, unit):
            at, _ = first_units(piece, told)
            covered = marked(len(piece.values), at, at + unit.length)
            for a, b, row in zip(piece.ends, piece.ends[1:], rows):
                covered[a:b] |= np.unpackbits(np.frombuffer(row.covered, np.uint8), count=b - a).astype(bool)
                out.append(finished(row, covered[a:b], finish))
    return _typed(out)


def removed(
    corpus: Corpus, unit: Unit, address: Callable, settle: Callable[[pd.DataFrame], pd.DataFrame], finish: Callable
) -> DataFrame:
    """``(doc_id, n_units, n_removed, n_spans, sha)`` of every row with an id.

    ``address(batch, starts, hashes)`` gives the group of each open window and its leading
    units; ``settle(frame)`` returns the windows of such a group that an earlier text holds.
    """
    texts, groups, n = corpus.texts, corpus.groups, shuffle_partitions(corpus.texts.sparkSession)
    dealt = lambda df: df.repartition(n, "to").groupBy("to")
    sent = texts.mapInArrow(_send_anchors(unit, groups), PACKED)
    # Each step is stored, so that the shuffle files of the one before go as soon as it ends.
    found = stored(dealt(sent).applyInPandas(lambda f: settle_anchors(f, unit, groups), FOUND))
    two = stored(dealt(texts).cogroup(dealt(found)).applyInPandas(
        lambda t, f: stage_two(t, f, unit, address, finish), STAGE
    ))
    windows = two.where(F.col("kind") == WINDOWS).select("to", *WINDOW_KINDS)
    covered = stored(dealt(windows).applyInPandas(settle, FOUND))
    waiting = two.where(F.col("kind") == WAITING).select("to", "doc_id", "check", "times", "covered", "text")
    three = dealt(waiting).cogroup(dealt(covered)).applyInPandas(lambda t, f: stage_three(t, f, unit, finish), STAGE)
    columns = ["doc_id", "times", "n_units", "n_removed", "n_spans", "sha"]
    rows = two.where(F.col("kind") == DONE).select(columns).union(three.select(columns))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("_copy", "times")


def repeated_windows(frame: pd.DataFrame, order_by: Callable, own: bool, groups: int) -> pd.DataFrame:
    """The windows of a group that repeat an earlier one, addressed to the groups of their texts."""
    c = {k: unpack(frame, k, kind) for k, kind in WINDOW_KINDS.items()}
    order, repeat = order_by(c, own)
    rows = order[repeat]
    columns = {k: c[k][rows] for k in ("ids", "checks", "at")}
    columns["settled"] = np.full(len(rows), 2, np.int8)
    return split(homes(columns["ids"], columns["checks"], groups), columns, ["ids", "checks", "at", "settled"])


def words_kept(text: bytes, mask: np.ndarray) -> bytes:
    start, stop = word_bounds(np.frombuffer(text, np.uint8))
    return b" ".join(text[a:b] for a, b in zip(start[~mask], stop[~mask]))
