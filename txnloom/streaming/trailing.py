"""Trailing churn windows: the steps up to and including a customer's newest one, kept as state.

The state of a customer is a summary of each of its last ``window_steps`` steps (counts, amount, low-balance run).
Customers are dealt to ``GROUPS`` groups by a hash, and a group's state is one small table that is read and written
once a trigger: a call of Python per customer costs milliseconds, whatever it does, while one per group works on
columns of all its customers. A trigger that has no rows of a group leaves its state alone.

Rows are never put together: each arriving batch is reduced to stretches of 62 offsets with a bit per event, which
combine in any order; only these are put in order, and neighbours meet in pairs. A customer is given up two windows
after the newest row, at the latest when its whole group is.

A row that is older than the window that ends with the customer's newest step is left out, as it lies in no
window that is still emitted. Rows without a type or a step take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import runs
from ..functions.clock import event_ts
from ..functions.rules import parsed
from ..operators.churn import BITS
from ..params import ChurnParams
from ..session import ship_package

#: Groups of customers, each one key of the state: it stays the same as long as a checkpoint is used.
GROUPS = 4096
#: Stretches of a group that wait before they are added up, so that a very active customer does not fill the memory.
_WAITING = 100_000

_SUMMARY = ("n", "amount", "n_amount", "cashout", "payment_debit", "pre", "suf", "best")
_WINDOW = ("customerId string, end_step int, w_count long, w_avg_amount double, cashout_count long, "
           "payment_debit_count long, low_run long")
_CASHOUT, _PAYMENT_DEBIT, _LOW = 1, 2, 4
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HOUR_MS = 3_600_000
_FIRST = np.iinfo(np.int64).min


def epoch_hours(epoch: str) -> int:
    """Whole hours from 1970 to the simulation's first step."""
    at = datetime.fromisoformat(epoch.replace("Z", "+00:00"))
    return int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()) // 3600


def _starts(*keys: np.ndarray) -> np.ndarray:
    """True where a row of sorted keys differs from the row before."""
    start = np.ones(len(keys[0]), bool)
    start[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return start


def _append(left: list[np.ndarray], right: list[np.ndarray]) -> list[np.ndarray]:
    """Summaries of two neighbouring stretches as one, for many pairs; columns as in ``_SUMMARY``."""
    sums = [a + b for a, b in zip(left[:5], right[:5])]
    pre = np.where(left[5] == left[0], left[0] + right[5], left[5])
    suf = np.where(right[6] == right[0], right[0] + left[6], right[6])
    return [*sums, pre, suf, np.maximum(np.maximum(left[7], right[7]), left[6] + right[5])]


def folded(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One summary per key of rows that lie in order: neighbours are put together in pairs until one is left."""
    while True:
        start = _starts(*keys)
        first = np.flatnonzero(start)
        if len(first) == len(start):
            return keys, values
        place = np.arange(len(start)) - np.repeat(first, np.diff(first, append=len(start)))
        left = np.flatnonzero(place % 2 == 0)
        paired = np.append(~start[1:], False)[left]
        met = _append(*[[v[left[paired] + k] for v in values] for k in (0, 1)])
        keys, values = [k[left] for k in keys], [v[left] for v in values]
        for v, m in zip(values, met):
            v[paired] = m


def runs_of_bits(there: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """Low run at the start, at the end, and the longest, of the events whose bits are set, for many stretches."""
    n, run, pre, best = (np.zeros(len(there), np.int64) for _ in range(4))
    for i in range(BITS if len(there) else 0):
        event = there >> i & 1
        n += event
        run = np.where(event == 1, (run + 1) * (low >> i & 1), run)
        best = np.maximum(best, run)
        pre = np.where(run == n, n, pre)
    return [pre, run, best]


def run_summaries(there: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """As ``runs_of_bits``; most stretches hold one event, which needs no walk over the places."""
    there = there & ((1 << BITS) - 1)
    single = (there != 0) & (there & (there - 1) == 0)
    out = [np.where(single & (there & low != 0), 1, 0) for _ in range(3)]
    rest = np.flatnonzero(~single)
    for o, r in zip(out, runs_of_bits(there[rest], low[rest])):
        o[rest] = r
    return out


def added_up(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Sums per customer, step and stretch, in this order; the first three columns are the key."""
    order = np.lexsort(rows[2::-1])
    rows = [r[order] for r in rows]
    first = np.flatnonzero(_starts(*rows[:3]))
    return [r[first] for r in rows[:3]] + [np.add.reduceat(r, first) for r in rows[3:]]


def stretches_of(pdf: pd.DataFrame, names: dict[str, int]) -> list[np.ndarray]:
    """Customer number, step, stretch, n, amount, n_amount, cashout, payment_debit, there and low of a batch of rows.

    ``names`` numbers the customers and takes in new ones.
    """
    codes, found = pd.factorize(pdf["customerId"].to_numpy())
    at, flags, amount = pdf["at"].to_numpy(np.int64), pdf["flags"].to_numpy(np.int64), pdf["amount"].to_numpy(np.float64)
    known = ~np.isnan(amount)
    bit = np.left_shift(np.int64(1), at % BITS)
    # Offsets are unique, so the sum of the bits is their union.
    # Every column keeps its own type: 62 bits do not fit into the 53 of a double.
    return added_up([np.array([names.setdefault(c, len(names)) for c in found], np.int64)[codes],
                     pdf["step"].to_numpy(np.int64), at // BITS, np.ones(len(pdf), np.int64), np.where(known, amount, 0.0),
                     known.astype(np.int64), flags & _CASHOUT, flags // _PAYMENT_DEBIT & 1, bit, np.where(flags & _LOW, bit, 0)])


def _arrived(batches: Iterator[pd.DataFrame], names: dict[str, int]) -> list[np.ndarray]:
    """All batches as stretches, added up now and then."""
    parts: list[list[np.ndarray]] = []
    for pdf in batches:
        parts.append(stretches_of(pdf, names))
        if sum(len(x[0]) for x in parts[1:]) > max(len(parts[0][0]), _WAITING):
            parts = [added_up([np.concatenate(c) for c in zip(*parts)])]
    return parts[0] if len(parts) == 1 else added_up([np.concatenate(c) for c in zip(*parts)])


def _stored(names: list[str], customer: np.ndarray, step: np.ndarray, values: list[np.ndarray]) -> bytes:
    """A group's state: a row per customer and step. Threads cost more than so few rows are worth."""
    ids = pa.array(np.array(names, object)[customer], pa.string())
    table = pa.table([ids, step, *values], names=["customerId", "step", *_SUMMARY])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _held(state: GroupState) -> tuple[list[str], list[np.ndarray]]:
    """Customers of a group, and customer number, step and summary of its rows."""
    if not state.exists:
        return [], [np.zeros(0, np.float64 if c == "amount" else np.int64) for c in ("customer", "step", *_SUMMARY)]
    with pa.ipc.open_stream(bytes(state.get[0]), options=pa.ipc.IpcReadOptions(use_threads=False)) as stored:
        ids, *columns = stored.read_all().combine_chunks().columns
    ids = ids.combine_chunks().dictionary_encode()
    return ids.dictionary.to_pylist(), [ids.indices.to_numpy().astype(np.int64), *(c.to_numpy() for c in columns)]


def trailing_group(p: ChurnParams) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Update of one group of customers; see the module for what a trigger reads and writes."""
    span, epoch_hour = p.window_steps, epoch_hours(p.epoch)

    def gone_ms(last):
        return (epoch_hour + last - 1 + 2 * span) * _HOUR_MS

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, before = _held(state)
        names = {c: i for i, c in enumerate(held)}
        customer, step, stretch, *sums, there, low = _arrived(batches, names)
        # What is held of a step comes before what arrives.
        rows = [np.concatenate(c) for c in zip([*before[:2], np.full(len(before[0]), _FIRST), *before[2:]],
                                               [customer, step, stretch, *sums, *run_summaries(there, low)])]
        last = np.full(len(names), _FIRST)
        np.maximum.at(last, rows[0], rows[1])
        changed = np.zeros(len(names), bool)
        changed[customer] = True
        watermark = state.getCurrentWatermarkMs()
        stays = (rows[1] > (last - span)[rows[0]]) & (changed | (gone_ms(last) > watermark))[rows[0]]
        order = np.flatnonzero(stays)[np.lexsort([r[stays] for r in rows[2::-1]])]
        customer, step, _, *values = [r[order] for r in rows]
        (customer, step), values = folded([customer, step], values)
        state.update((_stored(list(names), customer, step, values),))
        state.setTimeoutTimestamp(max(gone_ms(int(last.max())), watermark + 1))
        now = changed[customer]
        (customer,), total = folded([customer[now]], [v[now] for v in values])
        # Sums of cents in binary carry noise far below a cent; the average must not show it.
        avg = np.array([round(a, 6) / n if n else None for a, n in zip(total[1].tolist(), total[2].tolist())], np.float64)
        out = [np.array(list(names), object)[customer], last[customer], total[0], avg, total[3], total[4], total[7]]
        yield pd.DataFrame(dict(zip([c.split()[0] for c in _WINDOW.split(", ")], out)))

    return update


def trailing_stream(txns: DataFrame, p: ChurnParams = ChurnParams()) -> DataFrame:
    """Stream of customers' trailing windows, each time they change; needs RocksDB as state store."""
    spark = txns.sparkSession
    ship_package(spark)
    if spark.conf.get(_STATE_STORE, "") != _ROCKSDB:
        spark.conf.set(_STATE_STORE, _ROCKSDB)
    kind = F.col("type")
    flags = (F.when(kind == "CASH_OUT", _CASHOUT).when(kind.isin("PAYMENT", "DEBIT"), _PAYMENT_DEBIT).otherwise(0)
             + F.when(runs.is_low(F.col("newbalanceOrig"), p.balance_low_threshold), _LOW).otherwise(0))
    rows = (txns.filter(parsed() & F.col("step").isNotNull())
            .withColumn("event_ts", event_ts(F.col("step"), p.epoch))
            .withWatermark("event_ts", f"{p.watermark_hours + p.window_steps} hours")
            .select(F.pmod(F.xxhash64("nameOrig"), F.lit(GROUPS)).cast("int").alias("group"), F.col("nameOrig").alias("customerId"),
                    "event_ts", F.col("step").cast("int").alias("step"), F.col("kafka_offset").cast("long").alias("at"),
                    F.col("amount").cast("double").alias("amount"), flags.alias("flags")))
    updated = rows.groupBy("group").applyInPandasWithState(
        trailing_group(p), _WINDOW, "rows binary", "update", GroupStateTimeout.EventTimeTimeout)
    end = F.timestamp_seconds((F.lit(epoch_hours(p.epoch)) + F.col("end_step")).cast("long") * 3600)
    start = end - F.expr(f"INTERVAL {p.window_steps} HOURS")
    return updated.select("customerId", F.struct(start.alias("start"), end.alias("end")).alias("window"),
                          "w_count", "w_avg_amount", "cashout_count", "payment_debit_count", "low_run")
