"""Stateful streams that take a key's rows in any order: thread state after each step, and online Q updates.

Rows that are too early wait in keyed state and leave in order, so neither the order of files nor the
size of a micro-batch changes a result. A bounded run ends with one closing row far in the future, whose
watermark fires the timers of all keys that still hold rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import sqrt

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corvane.scale import scratch_path
from corvane.sources.records import _SEP, parse_game_records

# Stateful processors also start in a process that gets no shipped files, so they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Event time of the closing row, and the least one that is taken for it.
_CLOSING, _CLOSED = "2261-01-01 00:00:00", pd.Timestamp("2200-01-01")
_AT = "event_time"  # a name with a leading underscore would not reach the processor
#: Longest disorder that a bounded run over a table can meet: rows wait until the table has ended.
WHOLE_TABLE = "36500 days"
_DAY_MS = 86_400_000


class Closable:
    """A stream with an event time, together with the folder that its closing row goes to.

    ``build`` makes the stateful query from the rows with their event time in ``event_time``.
    """

    def __init__(self, rows: DataFrame, build, delay: str):
        spark = rows.sparkSession
        self.folder = scratch_path(spark, "closing")
        self.schema = rows.schema
        self._closing().limit(0).write.parquet(self.folder)
        self.stream = build(rows.unionByName(spark.readStream.schema(self.schema).parquet(self.folder))
                            .withWatermark(_AT, delay))

    def _closing(self) -> DataFrame:
        spark = SparkSession.active()
        values = [F.lit(_CLOSING).cast("timestamp").alias(f.name) if f.name == _AT
                  else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        return spark.range(1).select(*values)

    def close(self) -> None:
        self._closing().write.mode("append").parquet(self.folder)


class _ThreadState(StatefulProcessor):
    """Totals of a thread up to its next turn; later turns wait by number until those before them are there."""

    def __init__(self, roles: Sequence[str], first: int):
        self.roles, self.first = tuple(roles), first

    def init(self, handle: StatefulProcessorHandle) -> None:
        counts = ", ".join(f"n_{r} long" for r in self.roles)
        self.handle = handle
        self.totals = handle.getValueState("totals", f"{counts}, n_chars long, next long")
        self.waiting = handle.getMapState("waiting", "turn long", "roles array<string>, texts array<string>")

    def _held(self) -> list[int]:
        return list(self.totals.get()) if self.totals.exists() else [0] * (len(self.roles) + 1) + [self.first]

    def _step(self, key, held: list[int], turn: int, role: str, text: str | None) -> tuple:
        if role in self.roles:
            held[self.roles.index(role)] += 1
        held[-2] += len(text) if text is not None else 0
        held[-1] = max(held[-1], turn + 1)
        return (key[0], turn, *held[:-1], sum(held[:-2]), role, text)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        names = ["conv_id", "turn", *[f"n_{r}" for r in self.roles], "n_chars", "n_messages", "last_role", "last_text"]
        return pd.DataFrame(out, columns=names)

    def _leave(self, key, held: list[int], turn: int) -> list[tuple]:
        roles, texts = self.waiting.getValue((turn,))
        self.waiting.removeKey((turn,))
        return [self._step(key, held, turn, *x) for x in zip(roles, texts)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        early = {t for (t,) in self.waiting.keys()}
        for pdf in rows:  # one Arrow batch of the key at a time
            out: list[tuple] = []
            pdf = pdf[pdf[_AT] < _CLOSED].sort_values("turn", kind="stable")
            later: dict[int, list] = {}
            for turn, role, text in zip(pdf["turn"].tolist(), pdf["role"].tolist(), pdf["text"].tolist()):
                while held[-1] in early:
                    early.discard(held[-1])
                    out += self._leave(key, held, held[-1])
                if turn <= held[-1]:  # the next turn, or one that was passed before it came
                    out.append(self._step(key, held, turn, role, text))
                else:
                    later.setdefault(turn, []).append((role, text))
            while held[-1] in early:
                early.discard(held[-1])
                out += self._leave(key, held, held[-1])
            for turn, found in later.items():
                roles, texts = map(list, self.waiting.getValue((turn,))) if turn in early else ([], [])
                self.waiting.updateValue((turn,), (roles + [r for r, _ in found], texts + [x for _, x in found]))
                early.add(turn)
            if out:
                yield self._frame(out)
        if early:
            self.handle.registerTimer(_DAY_MS)
        self.totals.update(tuple(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The stream has ended: what still waits behind a missing turn leaves in order."""
        held, out = self._held(), []
        for turn in sorted(t for (t,) in self.waiting.keys()):
            out += self._leave(key, held, turn)
            if len(out) >= 1000:
                yield self._frame(out)
                out = []
        self.totals.update(tuple(held))
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


def stream_running_state(turns: DataFrame, roles: Sequence[str] = ("system", "user", "assistant"),
                         first: int = 0) -> Closable:
    """State of each thread (conv_id, turn, role, text) after every step, in append mode.

    Turns are numbered without gaps from ``first``. A turn is counted as soon as all before it are; one
    that comes early waits in state, one behind a missing turn until the stream is closed. A turn that
    comes twice is counted each time. Rows without a turn are not counted.
    """
    counts = ", ".join(f"n_{r} long" for r in roles)
    schema = f"conv_id long, turn long, {counts}, n_chars long, n_messages long, last_role string, last_text string"
    timed = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role",
                         "text", F.lit("1970-01-01 00:00:01").cast("timestamp").alias(_AT)).filter("turn is not null")

    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("conv_id").transformWithStateInPandas(_ThreadState(roles, first), schema, "Append", "EventTime")

    return Closable(timed, build, "1 hour")


class _QUpdate(StatefulProcessor):
    """Weights of one key, its step count and its open step (s, a, r); rows wait by time slice.

    Every call to state costs far more than a step, so the weights, one per state and action the key has
    taken, are one value that is read and written once for all slices that are due.
    """

    def __init__(self, gamma: float, slice_ms: int):
        self.gamma, self.slice_ms = gamma, slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.learnt = handle.getValueState("learnt", "n long, s string, a string, r double, event_id long, "
                                                     "features array<string>, weights array<double>")
        self.slices = handle.getValueState("slices", "ends array<long>, parts array<long>")
        self.waiting = handle.getMapState("waiting", "slice long, part long",
                                          "ts array<long>, event_id array<long>, s array<string>, a array<string>, r array<double>")

    def _slices(self) -> dict[int, int]:
        return dict(zip(*(self.slices.get() or ((), ()))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._slices()
        for pdf in rows:
            pdf = pdf[pdf[_AT] < _CLOSED]
            if pdf.empty:
                continue
            micros = pdf[_AT].astype("datetime64[us]").astype("int64")
            ends = (micros // 1000 // self.slice_ms + 1) * self.slice_ms
            for end, part in pdf.assign(__us=micros).groupby(ends.to_numpy()):
                end = int(end)
                if end not in held:
                    self.handle.registerTimer(end)
                self.waiting.updateValue((end, held.get(end, 0)), (
                    part["__us"].tolist(), part["event_id"].tolist(), part["s"].tolist(), part["a"].tolist(),
                    part["r"].astype(float).tolist()))
                held[end] = held.get(end, 0) + 1
        if held:
            ordered = sorted(held)
            self.slices.update((ordered, [held[e] for e in ordered]))
        return iter(())

    def _slice(self, end: int, parts: int) -> list[tuple]:
        """The rows of a slice by (ts, event_id), taken out of state."""
        out: list[tuple] = []
        for part in range(parts):
            out += zip(*self.waiting.getValue((end, part)))
            self.waiting.removeKey((end, part))
        return sorted(out, key=lambda x: x[:2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._slices()
        due = [e for e in sorted(held) if e <= expiredTimerInfo.getExpiryTimeInMs()]
        if not due:
            return
        n, *open_step, features, weights = self.learnt.get() or (0, None, (), ())
        known = dict(zip(features, weights))
        for end in due:  # one slice in memory at a time
            out = []
            for _, event_id, s, a, r in self._slice(end, held.pop(end)):
                if open_step[0] is not None:
                    s0, a0, r0, id0 = open_step
                    n += 1
                    # Fixed rule: step 1/sqrt(n), rate 50/(50 + step), target with the same next action.
                    alpha = 50 / (50 + 1 / sqrt(n))
                    feature = f"{s0}|{a0}"
                    old = known.get(feature, 0.0)
                    known[feature] = old + alpha * (r0 + self.gamma * known.get(f"{s}|{a0}", 0.0) - old)
                    out.append((key[0], id0, s0, a0, known[feature]))
                open_step = [s, a, float(r), int(event_id)]
            if out:
                yield pd.DataFrame(out, columns=["user_id", "event_id", "s", "a", "w"])
        self.learnt.update((n, *open_step, list(known), list(known.values())))
        self.slices.update((sorted(held), [held[e] for e in sorted(held)]))

    def close(self) -> None:
        pass


def stream_q_update(steps: DataFrame, gamma: float, delay: str = WHOLE_TABLE, slice_days: int = 30) -> Closable:
    """Weight after each transition of (user_id, ts, event_id, s, a, r), one weight table per user.

    Rows wait in state by slices of ``slice_days`` until the watermark, ``delay`` behind the latest time
    seen, has passed a slice; then the slice's steps are applied by (ts, event_id), whatever order and
    batches they came in. A row that comes later than the delay is dropped, as with any watermark, and
    so is one from before 1970, where watermarks start. A step is applied when the next one of its user is, so a terminal step is never applied. Rows without
    a time, state, action or reward are not steps.
    """
    timed = steps.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("event_id").cast("bigint").alias("event_id"),
                         "s", "a", F.col("r").cast("double").alias("r"), F.col("ts").cast("timestamp").alias(_AT)) \
        .dropna(subset=["event_id", "s", "a", "r", _AT])

    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").transformWithStateInPandas(
            _QUpdate(gamma, slice_days * _DAY_MS), "user_id long, event_id long, s string, a string, w double", "Append", "EventTime")

    return Closable(timed, build, delay)


def stream_records(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Game records of the files that arrive under ``path``, bad records skipped."""
    lines = (spark.readStream.option("lineSep", _SEP).option("maxFilesPerTrigger", max_files)
             .schema("value string").text(path))
    return parse_game_records(lines)


def _run(stream: DataFrame, path: str) -> bool:
    """Run a query until nothing is left; whether it met any row. A restarted query continues from its checkpoint."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/out")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return any(p["numInputRows"] for p in query.recentProgress)


def run_available(stream: DataFrame | Closable, name: str = "stream") -> DataFrame:
    """Run a stream over everything that is there now and read the written result.

    A closable stream is then closed, so rows that wait in state leave too. Output and checkpoint go
    to the shared folder, so a restarted query continues.
    """
    closable, stream = (stream, stream.stream) if isinstance(stream, Closable) else (None, stream)
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        found = _run(stream, path)
        if found and closable is not None:
            closable.close()
            _run(stream, path)
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    if not found:
        # An empty source gives an empty table; a wrong path fails when the stream is defined.
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")
