"""Conversation structure repair by a checkpointed dynamic program.

A conversation is repaired by the cheapest edits after which the initials of its roles
read ``(s?(ua)+)?``: Keep a row (0), Rerole it to user or assistant (2), Delete it (3),
Insert an empty user or assistant row (2); a row that is truncated costs 1 more unless
deleted; blank rows and duplicates must go. Of equally cheap edits the least in ASCII
order of their initials is taken: ``D < I < K < R``.

The program has four states: nothing yet, after s, after u, after a. Its costs run
backward, the edits forward. A conversation of n rows is cut into blocks of about the
square root of n. (1) Each block, wherever it lies, is reduced to its min-plus matrix
of four by four costs, so blocks of one conversation are spread over tasks. (2) From
the last block on the matrices are applied to the final costs; the cost vector after
each block is its checkpoint. (3) Walking forward, the vectors within a block are
computed anew from its checkpoint, and the tight edges of least initial are taken.
At any time a task holds the rows of one block, its checkpoint, and markers of blocks
whose rows tie with the present ones.

Step 3 streams a conversation's rows, in order, through one task: the digest of the
repaired text is a hash chain over all of them, which cannot be split. Its memory
doesn't grow with the conversation, but for the one letter per row of the audit.

Rows are ordered by turn, nulls first, then by a digest of role and text. Null role or
text: one space (so such a text is blank). A null conv_id is a conversation of its own.
A row is a duplicate if role and text were seen earlier in its conversation. Repeated rows
are duplicates. Empty texts are blank. Very long texts: like others, compared by SHA-256.
A role that is empty or begins with another letter can't be kept. Empty table: no rows.
Extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailytally.llm.common import stored

#: White space that leaves a text blank; marks that end a sentence.
SPACES = " \t\n\x0b\f\r"
ENDS = ".!?"
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. What follows an inserted row or a
#: rerole from each; the role that it gets.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: What follows a kept row of role s, u, a (codes 1, 2, 3) from each state; None: not allowed.
KEPT = {0: (None,) * 4, 1: (1, None, None, None), 2: (2, 2, None, 2), 3: (None, None, 3, None)}
#: Faults in the order in which the first counts.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
FAR = 1 << 40
DELETE, OTHER, CUT = 3, 2, 1
#: Costs after the last row: end, or insert what is lacking.
LAST = (0, 4, 2, 0)


def _closed(v: list[int]) -> tuple[int, ...]:
    """With inserted rows before: twice round, as u and a follow each other."""
    for _ in range(2):
        v = [min(v[s], v[NEXT[s]] + OTHER) for s in range(4)]
    return tuple(c if c < FAR else FAR for c in v)


def before(code: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, from the costs after it. ``code``: initial + 4 * fault."""
    initial, fault = code & 3, code >> 2
    out = [c + DELETE for c in v]
    if fault not in (BLANK, DUPLICATE):
        more = CUT if fault == TRUNCATED else 0
        for s in range(4):
            out[s] = min(out[s], v[NEXT[s]] + OTHER + more)
            if (to := KEPT[initial][s]) is not None:
                out[s] = min(out[s], v[to] + more)
    return _closed(out)


class Steps:
    """``before``, remembered: apart from a common amount there are few cost vectors."""

    def __init__(self) -> None:
        self.known: dict[tuple, tuple] = {}

    def __call__(self, code: int, v: tuple[int, ...]) -> tuple[int, ...]:
        low = min(v)
        key = (code, *[c - low if c < FAR else FAR for c in v])
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = before(code, key[1:])
        return tuple([c + low if c < FAR else FAR for c in got])


def matrix(codes: bytes, step: Steps) -> list[int]:
    """A block as a min-plus matrix: the cost from each state (row) to each one (column)."""
    columns = []
    for end in range(4):
        v = tuple(0 if s == end else FAR for s in range(4))
        for c in reversed(codes):
            v = step(c, v)
        columns.append(v)
    return [columns[e][s] for s in range(4) for e in range(4)]


def applied(m: list[int], v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(FAR, *(m[4 * s + e] + v[e] for e in range(4))) for s in range(4))


def walk(codes: bytes, after: tuple[int, ...], state: int, last: bool, step: Steps) -> tuple[str, int]:
    """The least tight edits of a block entered in ``state``, and the state it is left in."""
    costs = [after]
    for c in reversed(codes):
        costs.append(step(c, costs[-1]))
    costs.reverse()
    edits = []
    for i, c in enumerate(codes):
        initial, fault = c & 3, c >> 2
        more = CUT if fault == TRUNCATED else 0
        while True:
            here, then = costs[i], costs[i + 1]
            if then[state] + DELETE == here[state]:
                edits.append("D")
                break
            if here[NEXT[state]] + OTHER == here[state]:
                edits.append("I")
                state = NEXT[state]
                continue
            to = KEPT[initial][state]
            if to is not None and then[to] + more == here[state]:
                edits.append("K")
                state = to
            else:
                edits.append("R")
                state = NEXT[state]
            break
    while last and LAST[state]:
        edits.append("I")
        state = NEXT[state]
    return "".join(edits), state


def _space(c: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(c).cast(kind), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The damaged rows: conv_id, turn, role, text (see the query's contract)."""
    chance = F.crc32(F.encode(F.concat(_space("conv_id"), F.lit(":"), _space("turn")), "UTF-8")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(chance == 4, F.lit("user")).otherwise(_space("role")).alias("role"),
        F.when(chance == 1, F.lit("")).when(chance == 2, F.translate(_space("text"), ENDS, "")).otherwise(_space("text")).alias("text"),
        F.array_repeat(F.lit(0), F.when(chance == 0, 0).when(chance == 3, 2).otherwise(1).cast("int")).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("_copy")).drop("_copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows under a key without nulls, with a digest of role and text."""
    text, role = _space("text"), _space("role")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("ck"), F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("sig"),
        role.alias("role"), text.alias("text"),
    )


def _code() -> Column:
    """Initial (s, u, a: 1, 2, 3) + 4 * fault, duplicates left aside."""
    initial = F.substring("role", 1, 1)
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(bare == "", BLANK).when(
        ~F.substring(bare, -1, 1).isin(*ENDS), TRUNCATED).otherwise(NONE)
    return (F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0) + fault * 4).cast("int")


MARK = "ck string, block long, turn long, sig binary, codes binary, "


def _blocks(coded: DataFrame) -> DataFrame:
    """Step 1: each block's codes, first key and min-plus matrix."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, out, now = Steps(), [], None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["ck", "block", "turn", "sig", "codes", "m"])

        def close() -> None:
            out.append((*now[0], *now[1], bytes(now[2]), matrix(now[2], step)))

        for b in batches:
            for ck, block, turn, sig, code in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if now is None or now[0] != (ck, block):
                    if now is not None:
                        close()
                    now = ((ck, block), (turn, sig), bytearray())
                now[2].append(code)
            if len(out) >= 1000:
                yield batch()
        if now is not None:
            close()
        if out:
            yield batch()

    dealt = coded.repartition("ck", "block").sortWithinPartitions("ck", "block", "place")
    return dealt.select("ck", "block", "turn", "sig", "code").mapInArrow(reduce, MARK + "m array<long>")


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """Step 2: for each block the costs after it, and whether it is the last."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, v = None, LAST
        for b in batches:
            after, last, total = [], [], []
            for ck, m in zip(b.column(0).to_pylist(), b.column(5).to_pylist(), strict=True):
                last.append(ck != at)
                if ck != at:
                    at, v = ck, LAST
                after.append(v)
                v = applied(m, v)
                total.append(v[0])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(after, pa.list_(pa.int64())), pa.array(last, pa.bool_()), pa.array(total, pa.int64())],
                names=["ck", "block", "turn", "sig", "codes", "after", "last", "total"])

    dealt = blocks.repartition("ck").sortWithinPartitions("ck", F.desc("block"))
    return dealt.mapInArrow(back, MARK + "after array<long>, last boolean, total long")


TURNS = "ck string, conv_id long, step long, edit string, role string, text string"
AUDITS = ("ck string, conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


class _Walker:
    """Step 3 for the conversations of a task, row by row."""

    def __init__(self, digest: bool) -> None:
        self.digest, self.step = digest, Steps()
        self.out: list[tuple] = []
        self.ck: str | None = None

    def open(self, ck: str, conv_id: int | None) -> None:
        self.ck, self.conv_id = ck, conv_id
        self.marks: list[tuple] = []  # of blocks to come, in order
        self.held: list[tuple[str, str]] = []
        self.state, self.steps, self.cost = 0, 0, 0
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.audit: list[str] = []
        self.sha, self.first = hashlib.sha256(), True

    def mark(self, block: int, codes: bytes, after: list[int], last: bool, total: int) -> None:
        self.marks.append((block, codes, tuple(after), last, total))

    def row(self, role: str, text: str) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.held.append((role, text))
        if len(self.held) == len(self.marks[0][1]):
            self._block()

    def _block(self) -> None:
        block, codes, after, last, total = self.marks.pop(0)
        if block == 0:
            self.cost = total
        for c in codes:
            self.faults[c >> 2] += 1
        edits, to = walk(codes, after, self.state, last, self.step)
        rows = iter(self.held)
        state = self.state
        for e in edits:
            role, text = next(rows) if e != "I" else ("", "")
            if e in "IR":
                role = ROLE[state]
            if e in "IRK":
                state = KEPT["sua".index(role[0]) + 1][state] if e == "K" else NEXT[state]
            self._emit(e, role, text)
        self.state, self.held = to, []
        self.audit.append(edits)

    def _emit(self, edit: str, role: str, text: str) -> None:
        if not self.digest:
            self.out.append((self.ck, self.conv_id, self.steps, edit, *((None, None) if edit == "D" else (role, text))))
            self.steps += 1
        elif edit != "D":
            self.sha.update(b"" if self.first else b"\n")
            self.sha.update(f"{role}:{text}".encode())
            self.first = False

    def close(self) -> None:
        if self.ck is not None and self.digest:
            self.out.append((self.ck, self.conv_id, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()))

    def batch(self) -> pa.RecordBatch:
        names = [f.split()[0] for f in (AUDITS if self.digest else TURNS).split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in (AUDITS if self.digest else TURNS).split(", ")]
        cols = list(zip(*self.out, strict=True))
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _walked(rows: DataFrame, marks: DataFrame, digest: bool) -> DataFrame:
    """Rows and checkpoints of a conversation, in order, each marker before its block's rows."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Walker(digest)
        for b in batches:
            for ck, conv_id, kind, role, text, block, codes, after, last, total in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if ck != w.ck:
                    w.close()
                    w.open(ck, conv_id)
                if kind == 0:
                    w.mark(block, codes, after, last, total)
                else:
                    w.conv_id = conv_id
                    w.row(role, text)
                if len(w.out) >= 1000:
                    yield w.batch()
        w.close()
        if w.out:
            yield w.batch()

    no = {c: F.lit(None).cast(k) for c, k in (("role", "string"), ("text", "string"), ("block", "long"), ("codes", "binary"), (
        "after", "array<bigint>"), ("last", "boolean"), ("total", "long"), ("conv_id", "long"))}
    names = ["ck", "conv_id", "turn", "sig", "kind", "role", "text", "block", "codes", "after", "last", "total"]
    lines = rows.withColumns({"kind": F.lit(1)} | {c: v for c, v in no.items() if c not in rows.columns}).select(*names)
    signs = marks.withColumns({"kind": F.lit(0)} | {c: v for c, v in no.items() if c not in marks.columns}).select(*names)
    # Rows alike in the key are alike altogether, so places need not be carried.
    dealt = lines.unionByName(signs).repartition("ck").sortWithinPartitions("ck", F.asc_nulls_first("turn"), "sig", "kind", "block")
    return dealt.drop("turn", "sig").mapInArrow(stream, AUDITS if digest else TURNS)


def repair(rows: DataFrame, digest: bool = False) -> DataFrame:
    """The edits of each conversation (conv_id, turn, role, text): ck, conv_id, step, edit, role and
    text after it (null where deleted). With ``digest`` one row a conversation: the faults, adjacent
    roles out of order, the cost, the edits' initials and the SHA-256 of the repaired rows."""
    keyed = _keyed(rows)
    light = keyed.select("ck", "turn", "sig", _code().alias("code"))
    order = [F.asc_nulls_first("turn"), "sig", "code"]
    light = stored(light.withColumn("place", F.row_number().over(Window.partitionBy("ck").orderBy(*order)).cast("long") - 1), "conv-light")
    seen = light.groupBy("ck", "sig").agg(F.min("place").alias("seen"))
    side = light.groupBy("ck").agg(F.ceil(F.sqrt(F.count("*"))).alias("side"))
    again = F.when((F.col("place") > F.col("seen")) & (F.shiftright("code", 2) != BLANK), F.col("code").bitwiseAND(3) + 4 * DUPLICATE)
    coded = light.join(seen, ["ck", "sig"]).join(side, "ck").select(
        "ck", F.floor(F.col("place") / F.col("side")).alias("block"), "turn", "sig", F.coalesce(again, "code").alias("code"), "place")
    marks = stored(_checkpoints(_blocks(coded)), "conv-checkpoints")
    return _walked(keyed, marks, digest)


def repair_digests(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, repaired as ``rows`` are (its damaged rows)."""
    own = repair(rows, digest=True).drop("conv_id")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    gaps = rows.groupBy(key.alias("ck")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("ck", key)
    none = hashlib.sha256().hexdigest()
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_ids.join(own, "ck", "left").join(gaps, "ck", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
