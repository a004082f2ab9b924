"""Conversation structure repair by a square-root checkpointed dynamic program.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``: nothing, or an optional
system turn and then user and assistant in turns. The cheapest edits are found backwards: ``V(i, q)``
is the least cost of repairing the rows from ``i`` on when the initials so far lead to state ``q``. Inside a block of
rows only every square-root-th vector is stored; walking forward, one stretch between two stored
vectors is computed again at a time, and in every step the tight edit with the least letter is emitted. Letters decide the
state they lead to, so that walk yields the ASCII-least of the cheapest edit sequences.

How one huge conversation is spread: rows are range-partitioned by conversation, turn and the row's text, numbered, and cut
into blocks of at most ``BLOCK`` rows. Four backward passes give a block's min-plus matrix (state in, state
out, cost). A conversation's blocks are chained twice, over matrices and then over exit states only, which is one small
row a block. Then every block walks on its own. The digest of the repaired text is sequential by nature: rows of a conversation
stream through it in order, a batch in memory at a time.

Row order is turn (nulls first), then role and text for rows that share a turn.

Defined cases: null ids, turns, roles and texts count as one space (a null id is a conversation of its own and
comes back as null). Repeated rows are separate rows, all but the first of them duplicates. A conversation that the damage
empties has zeros, an empty audit and the digest of the empty string. Roles with other initials than s, u, a can only be
deleted or rewritten. An empty table gives an empty result, other columns are ignored, texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize

from .common import BLANKS

BLOCK = 4_096               # rows that one task repairs at a time, at most
PREFIX = 64                 # characters of a text that range bounds look at
SOUND, TRUNCATED, BAD = 0, 1, 2             # faults of a row: none, truncated, blank or duplicate
RANK = {"s": 0, "u": 1, "a": 2}             # initials that the grammar knows; others are 3
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
FAR = 1 << 40               # cost of what cannot be
START, SYSTEM, USER, ASSISTANT = range(4)   # states: nothing yet, or the initial read last
STATES = 4
LEGAL = {(0, 1), (1, 2), (2, 1)}            # su, ua, au
KEEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
TURNS = [USER, USER, ASSISTANT, USER]       # state after the one role that can be written or inserted
ENDS = [0, FAR, FAR, 0]                     # only the empty and a complete conversation may end
NAMES = {USER: "user", ASSISTANT: "assistant"}


# -- the dynamic program over the codes (initial, fault) of a block of rows ----------------------------


def closed(v: list[int]) -> list[int]:
    """Costs when rows may first be inserted (at most three: user, assistant, user)."""
    u, a = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return [min(v[START], INSERT + u), min(v[SYSTEM], INSERT + u), u, a]


def edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """Edits that consume a row: (letter, cost, next state) in order of their letters."""
    initial, fault = divmod(code, 3)
    out = [("D", DELETE, state)]
    if fault != BAD:
        extra = CUT_OFF if fault == TRUNCATED else 0
        if (state, initial) in KEEPS:
            out.append(("K", extra, KEEPS[state, initial]))
        out.append(("R", REROLE + extra, TURNS[state]))
    return out


EDITS = [[edits(q, code) for q in range(STATES)] for code in range(12)]


def before(code: int, v: list[int]) -> list[int]:
    """Cost vector in front of a row from the one behind it."""
    return closed([min(c + v[n] for _, c, n in EDITS[code][q]) for q in range(STATES)])


@lru_cache(maxsize=1 << 12)
def matrix(codes: bytes) -> list[int]:
    """Least cost from every state in front of the rows to every state behind them (row-major, before trailing inserts)."""
    unit = [[0 if q == z else FAR for q in range(STATES)] for z in range(STATES)]
    for code in reversed(codes):
        unit = [before(code, v) for v in unit]
    return [min(unit[z][q], FAR) for q in range(STATES) for z in range(STATES)]


def illegal_pairs(codes: bytes) -> int:
    """Adjacent initials other than su, ua, au."""
    return sum((a // 3, b // 3) not in LEGAL for a, b in zip(codes, codes[1:]))


def vector(m: list[int], v: list[int]) -> list[int]:
    """Cost vector in front of a block from the one behind it."""
    return [min(min(m[q * STATES + z] + v[z] for z in range(STATES)), FAR) for q in range(STATES)]


class Walk:
    """Cost vectors of a block: stored at checkpoints, computed again for one stretch at a time."""

    def __init__(self, codes: bytes, behind: list[int]):
        self.codes = codes
        self.stretch = max(1, round(len(codes) ** 0.5))
        self.marks: dict[int, list[int]] = {}
        v = behind
        for i in range(len(codes), -1, -1):
            if i < len(codes):
                v = before(codes[i], v)
            if i % self.stretch == 0 or i == len(codes):
                self.marks[i] = v
        self.first = -1
        self.vectors: list[list[int]] = []

    def _at(self, i: int) -> list[int]:
        """V(i); rows are asked for in ascending order."""
        first = i // self.stretch * self.stretch
        if first != self.first:
            last = min(first + self.stretch, len(self.codes))
            v, found = self.marks[last], [self.marks[last]]
            for k in range(last - 1, first - 1, -1):
                v = before(self.codes[k], v)
                found.append(v)
            self.first, self.vectors = first, found[::-1]
        return self.vectors[i - first]

    def run(self, state: int) -> tuple[str, int]:
        """Letters of the ASCII-least cheapest edits from ``state`` and the state behind the last row."""
        out: list[str] = []
        for i, code in enumerate(self.codes):
            v = self._at(i)
            behind = self._at(i + 1) if i + 1 - self.first < len(self.vectors) else self.marks[i + 1]
            while True:
                here = v[state]
                options = [("I", INSERT + v[TURNS[state]], TURNS[state])]
                options += [(x, c + behind[n], n) for x, c, n in EDITS[code][state]]
                letter, _, state = min(o for o in options if o[1] == here)
                out.append(letter)
                if letter != "I":
                    break
        return "".join(out), state


def final_inserts(state: int) -> str:
    """Inserts behind the last row of a conversation."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


# -- Spark ---------------------------------------------------------------------------------------------


def _space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the planted damage: crc32(conv_id:turn) % 20 says which."""
    kind = F.pmod(F.crc32(F.concat_ws(":", _space("conv_id"), _space("turn")).cast("binary")), F.lit(20))
    x = rows.select("conv_id", "turn", _space("role").alias("role"), _space("text").alias("text"), kind.alias("_kind"))
    x = x.filter("_kind <> 0").withColumns({
        "text": F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))})
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, F.lit(2)).otherwise(F.lit(1))))
    return x.select("conv_id", "turn", "role", "text", copies.alias("_copy")).drop("_copy")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows in order with ``at``: increasing over all rows, the written partition in its high bits."""
    near = F.substring("text", 1, PREFIX)
    x = rows.withColumn("_near", near).repartitionByRange(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "_near")
    x = x.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return materialize(x.drop("_near").withColumn("at", F.monotonically_increasing_id()), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """``conv_id, at, turn, initial, fault, blank, duplicate, truncated`` of every row: its first fault only."""
    bare = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
    x = turns.select("conv_id", "at", "turn", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
                     (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"),
                     F.sha2(F.concat_ws("\0", F.length("role"), "role", "text"), 256).alias("_said"))
    # First rows by position: both sides of the join have one row a position, however often a text recurs.
    first = x.groupBy("conv_id", "_said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("_first"))
    x = x.drop("_said").join(first, "at", "left")
    duplicate = ~F.col("blank") & F.col("_first").isNull()
    return x.withColumn("duplicate", duplicate).withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open")).drop("_first", "open")


def _code() -> Column:
    initial = F.lit(3)
    for ch, k in RANK.items():
        initial = F.when(F.col("initial") == ch, F.lit(k)).otherwise(initial)
    fault = F.when(F.col("blank") | F.col("duplicate"), F.lit(BAD)).when(F.col("truncated"), F.lit(TRUNCATED)).otherwise(F.lit(SOUND))
    return (initial * 3 + fault).cast("tinyint")


def blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, block, codes, m, edge, illegal``: at most ``BLOCK`` rows each, with the min-plus matrix of the block,
    its first and last code (one number) and its illegal pairs."""
    part = F.shiftleft(F.shiftright("at", 33), 33) + F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / BLOCK) * BLOCK
    x = rows.select("conv_id", part.alias("block"), F.struct("at", _code().alias("code")).alias("r"))
    x = x.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("r")).getField("code").alias("codes"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [bytes(c) for c in b.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("block"), pa.array(codes, pa.binary()),
                 pa.array([matrix(c) for c in codes], pa.list_(pa.int64())), pa.array([c[0] << 8 | c[-1] for c in codes], pa.int32()),
                 pa.array([illegal_pairs(c) for c in codes], pa.int64())], ["conv_id", "block", "codes", "m", "edge", "illegal"])

    return x.mapInArrow(step, f"conv_id {_id_type(rows)}, block long, codes binary, m array<long>, edge int, illegal long")


def _id_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _grouped(df: DataFrame, order: Column) -> DataFrame:
    """Rows of a conversation behind one another in a task, in ``order``."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order)


def backward(found: DataFrame) -> DataFrame:
    """Adds ``v``, the cost vector behind each block, and ``exits``: the state behind it for each state in front."""

    def chain(batches):
        conv, v = object(), None
        for b in batches:
            behind = []
            for c, m in zip(b.column("conv_id").to_pylist(), b.column("m").to_pylist()):
                if c != conv:
                    conv, v = c, closed(ENDS)
                behind.append(v)
                v = vector(m, v)
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pa.array(behind, pa.list_(pa.int64()))],
                                             ["conv_id", "block", "v"])

    kind = _id_type(found)
    slim = _grouped(found.select("conv_id", "block", "m"), F.desc("block"))
    v = slim.mapInArrow(chain, f"conv_id {kind}, block long, v array<long>")

    def step(batches):
        for b in batches:
            out = []
            for codes, behind in zip(b.column("codes").to_pylist(), b.column("v").to_pylist()):
                out.append([Walk(codes, behind).run(q)[1] for q in range(STATES)])
            yield pa.RecordBatch.from_arrays([b.column(k) for k in kept] + [pa.array(out, pa.list_(pa.int32()))], [*kept, "exits"])

    kept = ["conv_id", "block", "codes", "edge", "illegal", "v"]
    x = _with(found.drop("m"), v, ["v"]).select(*kept)
    return x.mapInArrow(step, f"conv_id {kind}, block long, codes binary, edge int, illegal long, v array<long>, exits array<int>")


def _with(x: DataFrame, more: DataFrame, cols: list[str]) -> DataFrame:
    """Join on (conv_id, block), a key of both sides; null ids are one conversation."""
    more = more.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), *cols)
    return x.join(more, (x["block"] == more["_block"]) & x["conv_id"].eqNullSafe(more["_conv"])).drop("_conv", "_block")


def forward(found: DataFrame) -> DataFrame:
    """``conv_id, block, illegal, audit``: illegal pairs and letters of every block.

    A block's pairs include the one with the block in front, its letters the inserts behind a conversation's last row.
    """
    kind = _id_type(found)

    def chain(batches):
        conv, state, last, held = object(), START, -1, None
        for b in batches:
            rows = []
            for c, block, edge, exits in zip(*[b.column(k).to_pylist() for k in ("conv_id", "block", "edge", "exits")]):
                if held is not None:
                    rows.append((*held, c != conv))
                pair = int(c == conv and (last // 3, (edge >> 8) // 3) not in LEGAL)
                if c != conv:
                    conv, state = c, START
                held = (c, block, state, pair)
                state, last = exits[state], edge & 255
            if rows:
                yield _entries(rows, b.schema.field("conv_id").type)
        if held is not None:
            yield _entries([(*held, True)], b.schema.field("conv_id").type)

    slim = _grouped(found.select("conv_id", "block", "edge", "exits"), F.asc("block"))
    entry = slim.mapInArrow(chain, f"conv_id {kind}, block long, entry int, pair int, is_last boolean")

    def step(batches):
        for b in batches:
            out = []
            for codes, v, q, is_last in zip(*[b.column(k).to_pylist() for k in ("codes", "v", "entry", "is_last")]):
                letters, state = Walk(codes, v).run(q)
                out.append(letters + (final_inserts(state) if is_last else ""))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pc.add(b.column("illegal"), b.column("pair")),
                                              pa.array(out, pa.string())], ["conv_id", "block", "illegal", "audit"])

    x = _with(found.drop("exits", "edge"), entry, ["entry", "pair", "is_last"])
    return x.mapInArrow(step, f"conv_id {kind}, block long, illegal long, audit string")


def _entries(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["conv_id", "block", "entry", "pair", "is_last"])


def digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, repaired_sha256``: the rows of a conversation stream past its letters.

    A block's letters sort in front of its rows; a row takes letters up to the first that is not an insert.
    """
    kind = _id_type(turns)
    bare = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
    x = turns.select("conv_id", "at", F.lit(1).alias("kind"), "role", "text", (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"))
    x = x.unionByName(audits.select("conv_id", F.col("block").alias("at"), F.lit(0).alias("kind"), F.lit("").alias("role"),
                                    F.col("audit").alias("text"), F.lit(False).alias("open")))
    x = x.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")

    def run(batches):
        out = Repaired()
        for b in batches:
            done = out.take(*[b.column(k).to_pylist() for k in ("conv_id", "kind", "role", "text", "open")])
            if done:
                yield _digest_rows(done, b.schema.field("conv_id").type)
        done = out.finish()
        if done:
            yield _digest_rows(done, b.schema.field("conv_id").type)

    return x.mapInArrow(run, f"conv_id {kind}, cost long, audit string, repaired_sha256 string")


def _digest_rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    c, cost, audit, sha = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(c, kind), pa.array(cost, pa.int64()), pa.array(audit), pa.array(sha)],
                                      ["conv_id", "cost", "audit", "repaired_sha256"])


class Repaired:
    """Digest and letters of the conversation that streams past."""

    def __init__(self):
        self.conv = object()
        self._new()

    def _new(self):
        self.sha, self.lines, self.cost, self.state = hashlib.sha256(), 0, 0, START
        self.audit: list[str] = []
        self.letters: Iterator[str] = iter("")

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _insert(self) -> None:
        self.state = TURNS[self.state]
        self.cost += INSERT
        self._line(NAMES[self.state], "")

    def _row(self, role: str, text: str, is_open: bool) -> None:
        for letter in self.letters:
            if letter == "I":
                self._insert()
                continue
            if letter == "D":
                self.cost += DELETE
            else:
                self.cost += (CUT_OFF if is_open else 0) + (REROLE if letter == "R" else 0)
                self.state = KEEPS[self.state, RANK[role[0]]] if letter == "K" else TURNS[self.state]
                self._line(role if letter == "K" else NAMES[self.state], text)
            return

    def _rest(self) -> None:
        """Inserts behind the last row of a conversation."""
        for _ in self.letters:
            self._insert()

    def take(self, convs, kinds, roles, texts, opens) -> list[tuple]:
        done = []
        for c, kind, role, text, is_open in zip(convs, kinds, roles, texts, opens):
            if c != self.conv:
                done += self.finish()
                self.conv = c
            if kind == 0:
                self.audit.append(text)
                self.letters = iter(text)
            else:
                self._row(role, text, is_open)
        return done

    def finish(self) -> list[tuple]:
        if not self.audit:
            return []
        self._rest()
        out = [(self.conv, self.cost, "".join(self.audit), self.sha.hexdigest())]
        self._new()
        return out


def repair(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id``: what the damage left behind and the cheapest repair."""
    ids = conversations.select("conv_id").distinct()
    turns = numbered(damage(conversations))
    rows = materialize(faults(turns), "turn-faults")
    walked = materialize(forward(materialize(backward(materialize(blocks(rows), "turn-blocks")), "turn-exits")), "turn-audits")
    done = digests(turns, walked)
    n = [F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")]
    counts = rows.groupBy("conv_id").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), *n)
    # Distinct turns in two steps, so that a huge conversation is grouped by turn first.
    distinct = rows.filter("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    illegal = walked.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    out = ids
    for part in (counts, distinct, illegal, done):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, out["conv_id"].eqNullSafe(part["_conv"]), "left").drop("_conv")
    gaps = F.col("hi").cast("long") - F.col("lo") + 1 - F.col("n_turns")
    whole = [F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in (
        ("gaps", gaps), *((k, F.col(k)) for k in ("blank", "duplicate", "truncated", "illegal", "cost")))]
    return out.select("conv_id", *whole, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
