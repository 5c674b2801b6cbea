"""Building blocks that keep an operator whole when one key holds much of the data.

Nothing here moves a group of unknown size into one task or to the driver: groups
are counted first, and a group above ``ROWS_PER_TASK`` is cut into ordered ranges.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 1_000_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 2 ** 20
_BUCKETS = 4096
_COLLECT_ROWS = 10_000
_PART = "__part"

_local_dirs: dict[str, str] = {}


def limit(spark: SparkSession, name: str, default: int, given: int | None = None) -> int:
    """A size limit: the argument, else session setting ``spark.corvane.<name>``, else the default."""
    return given if given is not None else int(spark.conf.get(f"spark.corvane.{name}", str(default)))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_dirs[app] = tempfile.mkdtemp(prefix="corvane-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back with its lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Re-partition by its unique key a scan with at most half as many splits as the session has cores.

    Small or single-row-group files would otherwise leave most cores idle during heavy
    per-row work. A large table has more splits and is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() <= cores // 2 else df


def group_sizes(df: DataFrame, key: Sequence[str]) -> tuple[int, int]:
    """(all rows, rows of the largest ``key`` group); counts are combined before the shuffle."""
    if not key:
        n = df.count()
        return n, n
    counts = df.groupBy(*key).agg(F.count("*").alias("__n"))
    row = counts.agg(F.sum("__n").alias("n"), F.max("__n").alias("top")).first()
    return row["n"] or 0, row["top"] or 0


def _row_bytes(df: DataFrame) -> Column:
    """Rough bytes of a row: 8 per plain value, the text length of strings and nested values."""
    size = F.lit(0).cast("bigint")
    for field in df.schema:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = size + 8 + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 8 + F.coalesce(F.length(F.to_json(F.struct(col))), F.lit(0))
        else:
            size = size + 8
    return size


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> tuple[int, bool]:
    """(rows, whether all of ``df`` may be broadcast), from one aggregate over it."""
    max_rows = limit(df.sparkSession, "broadcastRows", BROADCAST_ROWS, max_rows)
    max_bytes = limit(df.sparkSession, "broadcastBytes", BROADCAST_BYTES, max_bytes)
    row = df.select(_row_bytes(df).alias("b")).agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    return row["n"], row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


class Ordered:
    """Ordered-sequence functions per key, correct for keys of any size.

    ``order`` names ascending columns that are unique inside a key. While every key
    fits a task, all functions share one window (one shuffle, one sort). Otherwise
    rows are range-partitioned on (key, order), so a hot key spans many tasks, the
    functions run inside each range, and one small row per (key, range) carries
    counts, sums and edge rows across the cuts.
    """

    def __init__(self, df: DataFrame, key: Sequence[str], order: Sequence[str],
                 rows_per_task: int | None = None, sizes: tuple[int, int] | None = None):
        rows_per_task = limit(df.sparkSession, "rowsPerTask", ROWS_PER_TASK, rows_per_task)
        self.key, self.order = list(key), list(order)
        self.sizes = group_sizes(df, self.key) if sizes is None else sizes
        rows, largest = self.sizes
        self.split = largest > rows_per_task
        if self.split:
            parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                        -(-rows // rows_per_task))
            df = materialize(
                df.repartitionByRange(parts, *self.key, *self.order)
                .withColumn(_PART, F.spark_partition_id()), "ranges")
        self.df = df
        self._index: list[str] = []
        self._lag: dict[str, str] = {}
        self._lead: dict[str, str] = {}
        self._sums: dict[str, tuple[Column, bool]] = {}
        self._past: dict[str, tuple[list[str], int, bool]] = {}

    def index(self, name: str) -> "Ordered":
        """0-based position of the row in its key."""
        self._index.append(name)
        return self

    def lag(self, **cols: str) -> "Ordered":
        """``new=old``: value of column ``old`` on the previous row, else null."""
        self._lag.update(cols)
        return self

    def lead(self, **cols: str) -> "Ordered":
        """``new=old``: value of column ``old`` on the next row, else null."""
        self._lead.update(cols)
        return self

    def running(self, inclusive: bool = True, **exprs: Column) -> "Ordered":
        """Running sums up to the row, or up to the row before it."""
        for name, expr in exprs.items():
            self._sums[name] = (expr, inclusive)
        return self

    def history(self, name: str, cols: Sequence[str], last: int, include_self: bool = False) -> "Ordered":
        """Array of structs of the ``last`` rows before the row (or up to it), oldest first."""
        self._past[name] = (list(cols), last - 1 if include_self else last, include_self)
        return self

    def result(self) -> DataFrame:
        group = self.key + ([_PART] if self.split else [])
        w = Window.partitionBy(*group).orderBy(*self.order)
        local: dict[str, Column] = {}
        for name in self._index:
            local[name] = (F.row_number().over(w) - 1).cast("bigint")
        for name, old in self._lag.items():
            local[name] = F.lag(old).over(w)
        for name, old in self._lead.items():
            local[name] = F.lead(old).over(w)
        for name, (expr, inclusive) in self._sums.items():
            frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
            total = F.sum(expr).over(frame)
            local[name] = total if inclusive else F.coalesce(total, F.lit(0).cast("bigint"))
        for name, (cols, past, include_self) in self._past.items():
            frame = w.rowsBetween(-past, 0 if include_self else -1)
            local[name] = F.collect_list(F.struct(*cols)).over(frame)
        if not self.split:
            return self.df.withColumns(local)
        edge = {"__at": F.row_number().over(w) - 1, "__is_last": F.lead(F.lit(1)).over(w).isNull()}
        return self._carry(self.df.withColumns({**local, **edge}))

    def _tails(self, name: str) -> DataFrame:
        """The last rows of each (key, range) that the next range may need."""
        cols, past, _ = self._past[name]
        group = [*self.key, _PART]
        back = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in self.order])
        kept = self.df.select(*group, F.struct(*self.order).alias("__o"), F.struct(*cols).alias("__s"), *self.order) \
            .withColumn("__r", F.row_number().over(back)).filter(F.col("__r") <= past)
        items = F.array_sort(F.collect_list(F.struct("__o", "__s")))
        return kept.groupBy(*group).agg(F.transform(items, lambda x: x["__s"]).alias(f"__tail_{name}"))

    def _carry(self, local: DataFrame) -> DataFrame:
        at = F.struct(*self.order)
        aggs = [F.count("*").alias("__rows")]
        aggs += [F.sum(e).alias(f"__sum_{n}") for n, (e, _) in self._sums.items()]
        aggs += [F.max_by(F.struct(c), at).alias(f"__end_{n}") for n, c in self._lag.items()]
        aggs += [F.min_by(F.struct(c), at).alias(f"__end_{n}") for n, c in self._lead.items()]
        keyed = self.df.groupBy(*self.key, _PART).agg(*aggs)
        for n, (_, past, _) in self._past.items():
            if past:
                tails = self._tails(n)
                same = reduce(Column.__and__, [keyed[c].eqNullSafe(tails[c]) for c in [*self.key, _PART]])
                keyed = keyed.join(tails, same).select(keyed["*"], f"__tail_{n}")
        per_key = Window.partitionBy(*self.key)
        ordered = per_key.orderBy(_PART)
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        carried = {"__before": F.coalesce(F.sum("__rows").over(before), F.lit(0))}
        for n in self._sums:
            carried[f"__add_{n}"] = F.sum(f"__sum_{n}").over(before)
        for n in self._lag:
            carried[f"__edge_{n}"] = F.lag(f"__end_{n}").over(ordered)
        for n in self._lead:
            carried[f"__edge_{n}"] = F.lead(f"__end_{n}").over(ordered)
        for n, (_, past, _) in self._past.items():
            if past:  # every earlier range holds at least one row of the key
                near = F.flatten(F.collect_list(f"__tail_{n}").over(ordered.rowsBetween(-past, -1)))
                carried[f"__prior_{n}"] = near
        # Only keys that cross a cut need a carry: at most two per range.
        carry = (keyed.withColumn("__parts", F.count("*").over(per_key))
                 .withColumns(carried).filter("__parts > 1")
                 .select(*[F.col(k).alias(f"__k_{k}") for k in self.key],
                         F.col(_PART).alias("__k_part"), *carried))
        cond = F.col(_PART) == F.col("__k_part")
        for k in self.key:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        # With history the carry holds whole rows, so its size is left to the optimizer.
        out = local.join(carry if self._past else F.broadcast(carry), cond, "left")
        fixed: dict[str, Column] = {}
        for n in self._index:
            fixed[n] = F.col(n) + F.coalesce("__before", F.lit(0))
        for n, c in self._lag.items():
            fixed[n] = F.when(F.col("__at") == 0, F.col(f"__edge_{n}")[c]).otherwise(F.col(n))
        for n, c in self._lead.items():
            fixed[n] = F.when(F.col("__is_last"), F.col(f"__edge_{n}")[c]).otherwise(F.col(n))
        for n in self._sums:
            # A sum that has met only nulls so far is null; it must not hide what was carried, nor the reverse.
            fixed[n] = F.coalesce(F.col(n) + F.col(f"__add_{n}"), F.col(n), F.col(f"__add_{n}"))
        for n, (_, past, _) in self._past.items():
            if past:
                prior, short = F.col(f"__prior_{n}"), F.lit(past) - F.col("__at")
                first = F.greatest(F.size(prior) - short, F.lit(0)) + 1
                fixed[n] = F.when((short > 0) & prior.isNotNull(), F.concat(F.slice(prior, first, short), F.col(n))) \
                    .otherwise(F.col(n))
        keep = [c for c in local.columns if c not in (_PART, "__at", "__is_last")]
        return out.withColumns(fixed).select(*keep)


def global_index(df: DataFrame, order: Sequence[str], name: str = "ix",
                 rows_per_task: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the total order of unique columns ``order``.

    Only the order columns are ranked; the wide rows meet their position in a join.
    """
    order = list(order)
    narrow = Ordered(df.select(*order), [], order, rows_per_task).index(name).result()
    if set(df.columns) == set(order):
        return narrow
    same = reduce(Column.__and__, [df[c].eqNullSafe(narrow[c]) for c in order])
    return df.join(narrow, same).select(df["*"], narrow[name])


def _bounds(df: DataFrame) -> tuple[int, int, int]:
    row = df.agg(F.count("k").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    return row["n"], row["lo"], row["hi"]


def nth_smallest(df: DataFrame, key: str, n: int) -> tuple[int, int]:
    """Exact n-th smallest (1-based) integer key, and how many rows are below it.

    Each pass counts at most 4096 equal-width buckets and keeps the one holding the
    answer; keys are read, never sorted or collected beyond a small last bucket.
    """
    keys = df.select(F.col(key).cast("bigint").alias("k")).filter("k is not null")
    total, lo, hi = _bounds(keys)
    if not 1 <= n <= total:
        raise ValueError(f"n={n} outside 1..{total}")
    below = 0
    while True:
        if lo == hi:
            return lo, below
        width = -(-(hi - lo + 1) // _BUCKETS)
        inside = keys.filter(F.col("k").between(lo, hi))
        counts = inside.groupBy(F.expr(f"(k - ({lo}L)) div {width}L").alias("b")).count()
        hit = None
        for row in counts.orderBy("b").collect():
            if below + row["count"] >= n:
                hit = row
                break
            below += row["count"]
        lo, hi = lo + hit["b"] * width, min(hi, lo + (hit["b"] + 1) * width - 1)
        if hit["count"] <= _COLLECT_ROWS:
            last = sorted(r["k"] for r in keys.filter(F.col("k").between(lo, hi)).collect())
            k = last[n - below - 1]
            return k, below + last.index(k)


def hash_key(*cols: str | Column, seed: int) -> Column:
    """Uniform 60-bit integer from md5 of the values and a seed; equal on every engine."""
    joined = F.concat_ws(":", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols],
                         F.lit(str(seed)))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def uniform(*cols: str | Column, seed: int) -> Column:
    """Uniform double in [0, 1) that depends only on the values and the seed."""
    return hash_key(*cols, seed=seed).cast("double") / F.lit(float(2 ** 60))


def lookup_join(facts: DataFrame, dims: DataFrame, on: Sequence[str], how: str = "left",
                broadcast_rows: int | None = None, broadcast_bytes: int | None = None,
                rows_per_task: int | None = None, fits: bool | None = None) -> DataFrame:
    """Join a fact side of any skew to ``dims``, which is unique on ``on``.

    ``dims`` is broadcast only when measured to be small (``fits`` passes on an earlier
    measurement). Otherwise rows without a key, which match nothing, skip the join; the
    rows of hot keys meet a broadcast of the few ``dims`` rows they need; the rest is
    shuffled.
    """
    on = list(on)
    if fits is None:
        fits = fits_broadcast(dims, broadcast_rows, broadcast_bytes)[1]
    if fits:
        return facts.join(F.broadcast(dims), on, how)
    rows_per_task = limit(facts.sparkSession, "rowsPerTask", ROWS_PER_TASK, rows_per_task)
    keyed, keyless = facts.dropna(subset=on), facts.filter(~_all_present(on))
    counted = materialize(keyed.groupBy(*on).agg(F.count("*").alias("__n")).filter(F.col("__n") > rows_per_task), "hot")
    top = counted.agg(F.max("__n")).first()[0]
    hot = counted.select(*on)  # at most one key per rows_per_task rows
    if top is None:
        out = keyed.join(dims, on, how)
    else:
        salts = -(-top // rows_per_task)
        hot_dims = dims.join(F.broadcast(hot), on, "left_semi")
        hot_rows = keyed.join(F.broadcast(hot), on, "left_semi")
        if fits_broadcast(hot_dims, broadcast_rows, broadcast_bytes)[1]:
            hot_out = hot_rows.join(F.broadcast(hot_dims), on, how)
        else:  # few but wide rows: each goes to every salt, the facts to one
            salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
            hot_out = hot_rows.withColumn("__salt", salt).join(
                hot_dims.withColumn("__salt", every), [*on, "__salt"], how).drop("__salt")
        out = hot_out.unionByName(keyed.join(F.broadcast(hot), on, "left_anti").join(dims, on, how))
    if how in ("left", "left_anti"):
        out = out.unionByName(keyless, allowMissingColumns=True)
    return out


def _all_present(cols: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])
