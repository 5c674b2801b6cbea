"""Keyed streams give the same rows for any order of files and any size of micro-batch."""

import random
from math import sqrt

import pytest
from pyspark.sql import functions as F

from corvane.streaming import state as ss

ROLES = ("system", "user", "assistant")


def _threads():
    """Turns of several threads, one of them with a third of all, shuffled."""
    random.seed(2)
    rows = [(c, t, random.choice(ROLES), "x" * random.randint(0, 9)) for c in range(6) for t in range(60 if c == 0 else 24)]
    rows += [(7, t, "user", None) for t in (0, 1, 4, 5)]         # turns 2 and 3 never come
    rows += [(8, 0, "user", "a"), (8, 0, "user", "a"), (8, 1, "user", "b"), (None, 0, "user", "n"), (9, None, "user", "n")]
    random.shuffle(rows)
    return rows


def _plain_threads(rows):
    out = []
    for conv in {r[0] for r in rows}:
        held = {"system": 0, "user": 0, "assistant": 0}
        chars = 0
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv and r[1] is not None), key=lambda r: r[1]):
            held[role] += 1
            chars += len(text or "")
            out.append((conv, turn, *held.values(), chars, sum(held.values()), role, text))
    return out


def _files(spark, rows, schema, path, parts):
    """The rows dealt over files, so that each file holds rows of all keys and of no order."""
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema)


def _sorted(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("limit", [1, 100])
def test_thread_state_in_any_order(spark, tmp_path, limit):
    rows, schema = _threads(), "conv_id bigint, turn bigint, role string, text string"
    source = _files(spark, rows, schema, tmp_path / "in", 6).option("maxFilesPerTrigger", limit).parquet(str(tmp_path / "in"))
    got = [tuple(r) for r in ss.run_available(ss.stream_running_state(source), "threads").collect()]
    assert _sorted(r for r in got if r[0] != 8) == _sorted(r for r in _plain_threads(rows) if r[0] != 8)
    # A repeated turn counts when it comes, be it after its successor.
    assert sorted(r[6] for r in got if r[0] == 8) == [1, 2, 3]


def _steps():
    """Events of several users, one with a third of all, over ninety days, with equal times."""
    random.seed(3)
    users = [0] * 200 + [random.randint(1, 12) for _ in range(400)]
    rows = [(u, 86_400 * random.randint(1, 90) + random.choice([0, 5]), i, random.choice("pq"), random.choice("ab"),
             float(random.randint(0, 5))) for i, u in enumerate(users)]
    random.shuffle(rows)
    return rows


def _plain_steps(rows, gamma=0.9):
    out = []
    for user in {r[0] for r in rows}:
        weights, n, mine = {}, 0, sorted((r for r in rows if r[0] == user), key=lambda r: r[1:3])
        for (_, _, at, s, a, r), (_, _, _, after, _, _) in zip(mine, mine[1:]):
            n += 1
            old = weights.get((s, a), 0.0)
            weights[s, a] = old + 50 / (50 + 1 / sqrt(n)) * (r + gamma * weights.get((after, a), 0.0) - old)
            out.append((user, at, s, a, round(weights[s, a], 9)))
    return out


@pytest.mark.parametrize("limit,days", [(1, 1), (2, 30), (100, 400)])
def test_q_updates_in_any_order(spark, tmp_path, limit, days):
    rows, schema = _steps(), "user_id bigint, at bigint, event_id bigint, s string, a string, r double"
    source = _files(spark, rows, schema, tmp_path / "in", 5).option("maxFilesPerTrigger", limit).parquet(str(tmp_path / "in"))
    steps = source.withColumn("ts", F.timestamp_seconds("at"))
    got = ss.run_available(ss.stream_q_update(steps, 0.9, slice_days=days), "steps").withColumn("w", F.round("w", 9)).collect()
    assert _sorted(map(tuple, got)) == _sorted(_plain_steps(rows))


def test_steps_leave_as_the_watermark_passes(spark, tmp_path):
    """Files in order of time and a short delay: slices leave while the stream still runs."""
    rows = sorted(_steps(), key=lambda r: r[1])
    schema = "user_id bigint, at bigint, event_id bigint, s string, a string, r double"
    for i in range(0, len(rows), 120):
        spark.createDataFrame(rows[i:i + 120], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream = ss.stream_q_update(source.withColumn("ts", F.timestamp_seconds("at")), 0.9, delay="2 days", slice_days=5)
    before = spark.conf.get(ss._PROVIDER)
    spark.conf.set(ss._PROVIDER, ss._ROCKSDB)
    try:
        assert ss._run(stream.stream, str(tmp_path / "q"))
        early = {tuple(r) for r in spark.read.parquet(str(tmp_path / "q" / "out")).withColumn("w", F.round("w", 9)).collect()}
    finally:
        spark.conf.set(ss._PROVIDER, before)
    want = set(_plain_steps(rows))
    assert early < want and len(early) > len(want) // 2


def test_rows_without_values_are_no_steps(spark, tmp_path):
    rows = [(1, 10, 1, "p", "a", 1.0), (1, None, 2, "p", "a", 1.0), (1, 20, 3, None, "a", 1.0), (1, 30, 4, "q", None, 1.0),
            (1, 40, 5, "q", "a", None), (1, 50, 6, "q", "b", 2.0), (None, 60, 7, "q", "b", 2.0)]
    schema = "user_id bigint, at bigint, event_id bigint, s string, a string, r double"
    source = _files(spark, rows, schema, tmp_path / "in", 1).parquet(str(tmp_path / "in"))
    steps = source.withColumn("ts", F.timestamp_seconds("at"))
    got = ss.run_available(ss.stream_q_update(steps, 0.9), "few").collect()
    assert [(r["user_id"], r["event_id"], r["s"], r["a"]) for r in got] == [(1, 1, "p", "a")]


class _Counted:
    """State in memory that counts its calls."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, set()

    def getValueState(self, name, *_):
        return _CountedValue(self, name)

    getMapState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class _CountedValue:
    def __init__(self, of, name):
        self.of, self.name = of, name

    def _key(self, key=()):
        self.of.calls += 1
        return self.name, key

    def exists(self):
        return self._key() in self.of.values

    def get(self):
        return self.of.values.get(self._key())

    def update(self, value):
        self.of.values[self._key()] = value

    def containsKey(self, key):
        return self._key(key) in self.of.values

    def getValue(self, key):
        return self.of.values.get(self._key(key))

    def updateValue(self, key, value):
        self.of.values[self._key(key)] = value

    def removeKey(self, key):
        del self.of.values[self._key(key)]


def test_q_updates_call_state_a_few_times_a_key():
    """F16: calls to state follow slices, not the states and actions of a key."""
    import pandas as pd
    random.seed(16)
    rows = [(3, 86_400 * random.randint(0, 59) + i, i, f"s{random.randint(0, 30)}", random.choice("ab"), float(i % 7)) for i in range(400)]
    table = pd.DataFrame(rows, columns=["user_id", "at", "event_id", "s", "a", "r"])
    table[ss._AT] = pd.to_datetime(table["at"], unit="s")
    held, update = _Counted(), ss._QUpdate(0.9, 30 * ss._DAY_MS)
    update.init(held)
    assert list(update.handleInputRows((3,), iter([table]), None)) == []

    class Due:
        def __init__(self, at):
            self.getExpiryTimeInMs = lambda: at
    got = [tuple(r) for end in sorted(held.timers) for out in update.handleExpiredTimer((3,), None, Due(end))
           for r in out.itertuples(index=False)]
    assert len(held.timers) == 2 and held.calls <= 24
    assert _sorted((*r[:4], round(r[4], 9)) for r in got) == _sorted(_plain_steps(rows))
