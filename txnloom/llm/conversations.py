"""Conversation structure repair: cheapest edits that give an alternating dialogue, by an auction algorithm.

A conversation's rows and four dialogue states (start, after system, after user, after assistant) span a
lattice: deleting, keeping or changing a row's role moves to the next row, inserting an empty turn stays.
Every node has a price. A path grows from a node along its cheapest arc; where the price is below what the
cheapest arc and the price behind it cost, the price rises to that and the path gives up the node
(contraction), else the path takes the arc (extension) until it meets a node whose distance is settled.
Origins go from the last row to the first, so a settled node is never far and the work is linear in the
rows. Settled prices are distances to the end; the arcs they make tight are exactly those of cheapest edits,
and following the smallest letter among them gives the least of all cheapest edit strings.

Spark sorts the rows by conversation, turn, role and text over range partitions, so one conversation may
span many tasks. A task streams its rows and solves every conversation that it holds whole. Rows of those
that it may share with a neighbour, or that are longer than ``block_rows`` rows or ``block_bytes`` bytes, go
on as blocks: each block gives the cost between every entry and exit state, the blocks of a conversation
form a lattice of the same kind, its prices go back to the blocks, and these trace their own part. Only the
SHA-256 of a conversation's text has to be taken in order; it streams over the parts.

Defined cases: NULL roles and texts are one space, NULL turns come first; rows of one turn are ordered by
role and text; repeated rows are duplicates; rows marked ``gone`` only keep their conversation's id alive; a
conversation without other rows has zeros and empty strings; a NULL id is a conversation of its own; other
columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import ship_package, small_batches, stored

NEVER = 1 << 40
BLANKS = " \t\n\x0b\x0c\r"
#: What follows a state: the state after each role that may come, and the role that an insertion brings.
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEW = ("user", "user", "assistant", "user")
_FULL = (0, 3)
FINE, BLANK, DUPLICATE, CUT = range(4)


@dataclass(frozen=True)
class RepairParams:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    cut: int = 3
    block_rows: int = 1_024
    block_bytes: int = 4 << 20


# -- the lattice --------------------------------------------------------------
# A layer holds for each state its arcs (letter, cost, layers ahead, state), letters in order.

@lru_cache(maxsize=4_096)
def row_layer(fault: int, initial: str, p: RepairParams) -> tuple:
    out = []
    for q in range(4):
        new = _AFTER[q][_NEW[q][0]]
        arcs = [("D", p.delete, 1, q), ("I", p.insert, 0, new)]
        if fault in (FINE, CUT):
            extra = p.cut if fault == CUT else 0
            if initial in _AFTER[q]:
                arcs.append(("K", extra, 1, _AFTER[q][initial]))
            arcs.append(("R", p.rerole + extra, 1, new))
        out.append(tuple(arcs))
    return tuple(out)


def end_layer(p: RepairParams) -> tuple:
    """After the last row: stop where the dialogue is whole, or insert."""
    return tuple(((("", 0, 1, 0),) if q in _FULL else ()) + (("I", p.insert, 0, _AFTER[q][_NEW[q][0]]),) for q in range(4))


END = [0, NEVER, NEVER, NEVER]


def auction(layers: list[tuple], end: list[int]) -> list[list[int]]:
    """Distance to the end of every node, ``end`` being those behind the last layer."""
    price = [[0] * 4 for _ in layers] + [list(end)]
    settled = [[False] * 4 for _ in layers] + [[True] * 4]
    stops = bool(layers) and layers[-1][3][:1] == (("", 0, 1, 0),)
    if end[2] >= NEVER and end[3] >= NEVER and not stops:
        # States that only lead to each other never reach such an end; their prices would rise for ever.
        for values, known in zip(price[:-1], settled):
            values[2] = values[3] = NEVER
            known[2] = known[3] = True
    for start in range(len(layers) - 1, -1, -1):
        # No node is nearer to the end than the nearest of the next layer: prices that start there keep every
        # arc's condition and have only a few edits' costs left to rise.
        floor = min(price[start + 1])
        price[start] = [max(v, floor) for v in price[start]]
        for state in range(4):
            path = [(start, state)]
            while not settled[path[-1][0]][path[-1][1]]:
                i, q = path[-1]
                best, to = NEVER, None
                for _, cost, ahead, r in layers[i][q]:
                    value = cost + price[i + ahead][r]
                    if value < best:
                        best, to = value, (i + ahead, r)
                if price[i][q] < best:
                    price[i][q] = best
                    settled[i][q] = best == NEVER
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(to)
            for i, q in path:
                settled[i][q] = True
    return price


def trace(layers: list[tuple], price: list[list[int]], state: int) -> tuple[str, int]:
    """Least edit string along tight arcs from a state, and the state where it ends."""
    i, q, letters = 0, state, []
    while i < len(layers):
        for letter, cost, ahead, r in layers[i][q]:
            if cost + price[i + ahead][r] == price[i][q]:
                letters.append(letter)
                i, q = i + ahead, r
                break
        else:
            raise ValueError("no edit leads on from here")
    return "".join(letters), q


# -- rows ---------------------------------------------------------------------

def text_fault(text: str) -> int:
    body = text.rstrip(BLANKS)
    return BLANK if not body else FINE if body[-1] in ".!?" else CUT


def edited(rows: list[tuple[str, str]], letters: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of every edit that leaves a turn, for rows (role, text)."""
    at = 0
    for letter in letters:
        if letter == "I":
            role, text = _NEW[state], ""
        else:
            role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            if letter == "R":
                role = _NEW[state]
        state = _AFTER[state][role[0]]
        yield letter, role, text


@dataclass
class Tally:
    """Counts of consecutive rows that can be added to those of the rows behind them."""
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None

    def add(self, fault: int, initial: str, turn: int | None) -> None:
        self.join(Tally(1, fault == BLANK, fault == DUPLICATE, fault == CUT, 0, turn is not None, initial, initial, turn, turn))

    def join(self, o: Tally) -> None:
        if not o.rows:
            return
        if self.rows and self.last + o.first not in ("su", "ua", "au"):
            self.illegal += 1
        self.turns += o.turns - (self.high is not None and self.high == o.low)
        for k in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + getattr(o, k))
        self.first = o.first if self.first is None else self.first
        self.last = o.last
        self.low = o.low if self.low is None else self.low
        self.high = self.high if o.high is None else o.high

    def counts(self) -> dict[str, int]:
        return {"gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def solve(rows: list[tuple[int | None, str, str]], p: RepairParams = RepairParams()) -> tuple[Tally, int, str]:
    """Counts, cost and edits of one conversation's rows (turn, role, text) in order."""
    tally, seen, layers = Tally(), set(), []
    for turn, role, text in rows:
        fault = text_fault(text)
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        tally.add(fault, role[:1], turn)
        layers.append(row_layer(fault, role[:1], p))
    layers.append(end_layer(p))
    price = auction(layers, END)
    return tally, price[0][0], trace(layers, price, 0)[0]


# -- Spark --------------------------------------------------------------------

_COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_RESULT = f"{_COUNTS}, audit string, repaired_sha256 string"
_TURNS = "turns array<struct<edit:string,role:string,text:string>>"
_ROW = "block bigint, at int, turn bigint, role string, text string, fault int, digest binary, gone boolean"


def _schema(df: DataFrame, ddl: str) -> StructType:
    """The id's own type in front of further columns."""
    return StructType([df.schema["conv_id"], *StructType.fromDDL(ddl).fields])


def _table(rows: list[dict], schema: StructType) -> pa.Table:
    return pa.Table.from_pylist(rows, to_arrow_schema(schema))


def _hashed(turns: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in turns).encode("utf-8", "surrogatepass")).hexdigest()


def _shown(turns: list[tuple[str, str, str]]) -> list[dict[str, str]]:
    return [dict(zip(("edit", "role", "text"), t)) for t in turns]


class _Stream:
    """Sorted rows in, solved conversations or blocks of rows out."""

    def __init__(self, task: int, p: RepairParams, with_turns: bool):
        self.p, self.with_turns, self.next_block, self.out, self.id = p, with_turns, task << 33, [], None
        self.held: list[tuple] = []
        self.size, self.open, self.opened, self.blocks_only = 0, False, 0, False

    def add(self, conv, turn, role, text, gone) -> None:
        if not self.open or conv != self.id:
            # The first conversation may have begun in the task before.
            if self.open:
                self.close(whole=self.opened > 1)
            self.id, self.open, self.opened, self.blocks_only = conv, True, self.opened + 1, False
        self.held.append((turn, role, text, gone))
        self.size += len(text)
        if len(self.held) >= self.p.block_rows or self.size >= self.p.block_bytes:
            self.block()

    def block(self) -> None:
        for at, (turn, role, text, gone) in enumerate(self.held):
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
            self.out.append({"conv_id": self.id, "block": self.next_block, "at": at, "turn": turn, "role": role, "text": text,
                             "fault": text_fault(text), "digest": digest, "gone": gone})
        self.next_block += 1
        self.held, self.size, self.blocks_only = [], 0, True

    def close(self, whole: bool) -> None:
        if self.blocks_only or not whole:
            if self.held:
                self.block()
            return
        rows = [r[:3] for r in self.held if not r[3]]
        tally, cost, audit = solve(rows, self.p)
        turns = list(edited([r[1:] for r in rows], audit, 0))
        self.out.append({"conv_id": self.id, **tally.counts(), "cost": cost, "audit": audit, "repaired_sha256": _hashed(turns),
                         "turns": _shown(turns) if self.with_turns else None})
        self.held, self.size = [], 0


def _streamed(rows: DataFrame, p: RepairParams, with_turns: bool = False) -> DataFrame:
    """Results of conversations that lie inside a task (``block`` NULL) and blocks of rows of the others."""
    text = F.coalesce("text", F.lit(" "))
    held = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       text.alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"),
                       # Equal rows stay apart in the order, so that many of them can be dealt to many tasks.
                       F.monotonically_increasing_id().alias("_no"))
    order = ["conv_id", "turn", "role", F.substring("text", 1, 200), F.md5(F.col("text").cast("binary")), "_no"]
    ranged = held.repartitionByRange(*order).sortWithinPartitions(*order).drop("_no").withColumn("task", F.spark_partition_id())
    schema = _schema(rows, f"{_ROW}, {_RESULT}, {_TURNS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = None
        for batch in small_batches(batches, 3, 2 << 20):
            columns = [c.to_pylist() for c in batch.columns]
            stream = stream or _Stream(columns[5][0], p, with_turns)
            for conv, turn, role, text, gone in zip(*columns[:5]):
                stream.add(conv, turn, role, text, gone)
            yield from _table(stream.out, schema).to_batches()
            stream.out = []
        if stream:
            stream.close(whole=False)  # the last one may go on in the next task
            yield from _table(stream.out, schema).to_batches()

    ship_package(rows.sparkSession)
    return ranged.mapInArrow(run, schema)


def _block_layers(table: pa.Table, p: RepairParams) -> tuple[list[dict], list[tuple]]:
    rows = [r for r in sorted(table.to_pylist(), key=lambda r: r["at"]) if not r["gone"]]
    return rows, [row_layer(r["fault"], r["initial"], p) for r in rows]


def _pieces(streamed: DataFrame, p: RepairParams, ddl: str, show) -> tuple[DataFrame, DataFrame]:
    """Conversations given as blocks of rows: blocks solved apart, joined by prices at their borders.

    Returns what ``show`` makes of the repaired turns of every block, and the conversations' counts.
    """
    blocks = streamed.where(F.col("block").isNotNull()).select("conv_id", *StructType.fromDDL(_ROW).fieldNames())
    ship_package(blocks.sparkSession)
    seen = (blocks.where((F.col("fault") != BLANK) & ~F.col("gone")).groupBy("conv_id", "digest")
            .agg(F.min(F.struct("block", "at")).alias("seen"), F.count("*").alias("n")).where("n > 1").drop("n"))
    same = seen.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "seen")
    again = (F.col("fault") != BLANK) & F.col("seen").isNotNull() & (F.struct("block", "at") > F.col("seen"))
    marked = stored(blocks.join(same, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
                    .withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault")))
                    .withColumn("initial", F.substring("role", 1, 1))
                    .drop("_conv", "_digest", "seen", "digest"), "conversation-blocks")
    light = marked.drop("role", "text")
    tallied = ", ".join(f"{k} {'string' if k in ('first', 'last') else 'bigint'}" for k in Tally.__dataclass_fields__)
    summary = _schema(blocks, f"block bigint, {tallied}, between array<bigint>, final array<bigint>")
    borders = _schema(blocks, f"block bigint, ends boolean, behind array<bigint>, {_COUNTS}")
    leads = _schema(blocks, "block bigint, ends boolean, behind array<bigint>, exits array<int>")
    entries = StructType.fromDDL("block bigint, ends boolean, behind array<bigint>, entry int")
    parts = _schema(blocks, ddl)

    def summarise(table: pa.Table) -> pa.Table:
        rows, layers = _block_layers(table, p)
        tally = Tally()
        for r in rows:
            tally.add(r["fault"], r["initial"], r["turn"])
        ends = [auction(layers, [0 if r == q else NEVER for r in range(4)])[0] if layers else [0 if r == q else NEVER for r in range(4)]
                for q in range(4)]
        first = table.slice(0, 1).to_pylist()[0]
        return _table([{"conv_id": first["conv_id"], "block": first["block"], **{k: getattr(tally, k) if k in ("first", "last", "low", "high")
                        else int(getattr(tally, k)) for k in Tally.__dataclass_fields__},
                        "between": [ends[r][q] for q in range(4) for r in range(4)],
                        "final": auction([*layers, end_layer(p)], END)[0]}], summary)

    def chain(table: pa.Table) -> pa.Table:
        """Prices behind every block; counts go with the first."""
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        tally = Tally()
        for r in rows:
            tally.join(Tally(**{k: r[k] for k in Tally.__dataclass_fields__}))
        layers = [tuple(tuple(("", r["between"][4 * q + to], 1, to) for to in range(4) if r["between"][4 * q + to] < NEVER) for q in range(4))
                  for r in rows[:-1]]
        price = auction(layers, rows[-1]["final"])
        out = [{"conv_id": r["conv_id"], "block": r["block"], "ends": r is rows[-1],
                "behind": END if r is rows[-1] else price[k + 1]} for k, r in enumerate(rows)]
        out[0] |= tally.counts() | {"cost": price[0][0]}
        return _table(out, borders)

    def layers_of(table: pa.Table) -> tuple[dict, list[dict], list[tuple], list[list[int]]]:
        first = table.slice(0, 1).to_pylist()[0]
        rows, layers = _block_layers(table, p)
        layers = [*layers, end_layer(p)] if first["ends"] else layers
        return first, rows, layers, auction(layers, first["behind"])

    def lead(table: pa.Table) -> pa.Table:
        first, _, layers, price = layers_of(table)
        return _table([{k: first[k] for k in ("conv_id", "block", "ends", "behind")} | {
            "exits": [trace(layers, price, q)[1] if price[0][q] < NEVER else -1 for q in range(4)]}], leads)

    def follow(table: pa.Table) -> pa.Table:
        state, out = 0, []
        for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
            out.append({"block": r["block"], "ends": r["ends"], "behind": r["behind"], "entry": state})
            state = r["exits"][state]
        return pa.Table.from_pylist(out, to_arrow_schema(entries))

    def part(table: pa.Table) -> pa.Table:
        first, rows, layers, price = layers_of(table)
        letters = trace(layers, price, first["entry"])[0]
        turns = list(edited([(r["role"], r["text"]) for r in rows], letters, first["entry"]))
        return _table([{"conv_id": first["conv_id"], "block": first["block"], "audit": letters} | show(_shown(turns))], parts)

    summaries = stored(light.groupBy("block").applyInArrow(summarise, summary), "conversation-sums")
    bordered = stored(summaries.groupBy("conv_id").applyInArrow(chain, borders), "conversation-prices")
    known = bordered.select("block", "ends", "behind")
    picked = (light.join(known, "block").groupBy("block").applyInArrow(lead, leads)
              .groupBy("conv_id").applyInArrow(follow, entries))
    pieces = marked.join(stored(picked, "conversation-entries"), "block").groupBy("block").applyInArrow(part, parts)
    counts = bordered.where(F.col("cost").isNotNull()).drop("block", "ends", "behind").withColumnRenamed("conv_id", "_conv")
    return pieces, counts


def _joined_texts(turns: list[dict[str, str]]) -> dict[str, bytes]:
    return {"turns": "".join(f"\n{t['role']}:{t['text']}" for t in turns).encode("utf-8", "surrogatepass")}


def _across_blocks(streamed: DataFrame, p: RepairParams) -> DataFrame:
    """Results of the conversations that came as blocks."""
    pieces, counts = _pieces(streamed, p, "block bigint, audit string, turns binary", _joined_texts)
    whole = _schema(streamed, "audit string, repaired_sha256 string")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts in order, one conversation after the other."""
        at, audit, digest, begun = None, [], None, False
        for batch in batches:
            for k in range(batch.num_rows):
                conv, letters, data = (batch.column(c)[k].as_py() for c in (0, 2, 3))
                if digest is None or conv != at:
                    if digest is not None:
                        yield from _table([{"conv_id": at, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], whole).to_batches()
                    at, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(letters)
                digest.update(data if begun else data[1:])
                begun |= bool(data)
        if digest is not None:
            yield from _table([{"conv_id": at, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], whole).to_batches()

    texts = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(gather, whole)
    return texts.join(counts, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*_schema(streamed, _RESULT).fieldNames())


def repair_conversations(rows: DataFrame, p: RepairParams = RepairParams()) -> DataFrame:
    """Counts of faults, cost, edit string and hash of the repaired text of every conversation.

    ``rows`` has conv_id, turn, role, text and, optionally, gone.
    """
    rows = rows if "gone" in rows.columns else rows.withColumn("gone", F.lit(False))
    streamed = stored(_streamed(rows, p), "conversations")
    fields = _schema(rows, _RESULT).fieldNames()
    done = streamed.where(F.col("block").isNull()).select(*fields)
    return done.unionByName(_across_blocks(streamed, p))


def repaired_turns(rows: DataFrame, p: RepairParams = RepairParams()) -> DataFrame:
    """(conv_id, part, at, edit, role, text) of every turn of the repaired conversations, in order of part and at."""
    rows = rows if "gone" in rows.columns else rows.withColumn("gone", F.lit(False))
    streamed = stored(_streamed(rows, p, with_turns=True), "conversations")
    done = streamed.where(F.col("block").isNull()).select("conv_id", F.lit(0).cast("long").alias("part"), "turns")
    pieces, _ = _pieces(streamed, p, f"block bigint, {_TURNS}", lambda turns: {"turns": turns})
    found = done.unionByName(pieces.withColumnRenamed("block", "part"))
    return found.select("conv_id", "part", F.posexplode("turns").alias("at", "turn")).select("conv_id", "part", "at", "turn.*")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of conversation and turn picks; dropped ones are marked ``gone``."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    hurt = rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return hurt.withColumn("_copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "_copy")
