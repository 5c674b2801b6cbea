"""Operator 7: n-gram Jaccard join with prefix filters under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import linking
from corvane.llm.kernels import blocks, flat, lists, longs, mix, row_bounds, shingles
from corvane.llm.rows import (TABLE_ENTRIES, batch, frequent, fresh, materialize, shared, table,
                              texts)
from corvane.scale import fits_broadcast, lookup_join
from corvane.ship import ship

WIDTH, PERCENT, ORDERS = 5, 75, 3
_SEEN_TOKENS = 8 * 2 ** 20
_SEED = np.uint64(0xA0761D6478BD642F)
_BITS, _LANES = 512, [f"bits{i}" for i in range(8)]
_CELLS, _MARKS = 1024, [f"cells{i}" for i in range(16)]
_SEEDS = mix(np.arange(1, 17, dtype=np.uint64) * _SEED)


def set_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's token set; 0 for an empty one."""
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens ^ _SEED), out=total[1:])
    sizes = np.diff(bounds).astype(np.uint64)
    return np.where(sizes > 0, mix(total[bounds[1:]] - total[bounds[:-1]] + sizes) | np.uint64(1), np.uint64(0))


def _new(ids: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows bear a set that this task has not met; copies are dropped inside a task already."""
    out = np.zeros(len(ids), bool)
    for i, x in enumerate(ids.tolist()):
        if x and x not in seen:
            seen.add(x)
            out[i] = True
    return out


def parities(tokens: np.ndarray, owner: np.ndarray, n_rows: int) -> dict[str, pa.Array]:
    """512 bits per row: for each of 512 buckets, whether an odd number of the row's tokens fall into it.

    Two sets differ by at least as many tokens as their bits differ.
    """
    cells = owner * _BITS + (mix(tokens ^ _SEEDS[0]) >> np.uint64(64 - 9)).astype(np.int64)
    odd = (np.bincount(cells, minlength=n_rows * _BITS) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view(np.uint64).reshape(n_rows, len(_LANES))
    return {name: longs(words[:, i]) for i, name in enumerate(_LANES)}


def rows_and_tokens(source: DataFrame, width: int) -> DataFrame:
    """Two kinds of rows of one pass: (key columns, n, id) of every document, and (token, times) of the
    tokens that a task met in two sets or more, for the order of tokens."""
    ship(source.sparkSession)
    names = [c for c in source.columns if c != "text"]
    schema = source.select(*names).schema
    arrow = {c: source.schema[c].dataType.simpleString() for c in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0

        def counted(kind_of: dict[str, pa.DataType]) -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(held), return_counts=True)
            tokens, times = tokens[times > 1], times[times > 1]
            none = {c: pa.nulls(len(tokens), kind_of[c]) for c in names}
            none |= {c: pa.nulls(len(tokens), pa.int64()) for c in ("n", "id", *_LANES)}
            return batch(**none, token=longs(tokens), times=pa.array(times, pa.int64()))
        kinds = None
        for block in blocks(batches):
            kinds = {c: block.column(c).type for c in names}
            tokens, owner = shingles(*flat(block.column("text")), width)
            bounds = row_bounds(owner, block.num_rows)
            ids = set_ids(tokens, bounds)
            fresh = _new(ids, seen)
            held.append(tokens[fresh[owner]])
            size += len(held[-1])
            none = pa.nulls(block.num_rows, pa.int64())
            yield batch(**{c: block.column(c) for c in names}, n=pa.array(np.diff(bounds), pa.int64()), id=longs(ids),
                        **parities(tokens, owner, block.num_rows), token=none, times=none)
            if size > _SEEN_TOKENS:
                yield counted(kinds)
                held, size = [], 0
        if held:
            yield counted(kinds)
    columns = ", ".join(f"`{f.name}` {arrow[f.name]}" for f in schema)
    bits = ", ".join(f"{c} bigint" for c in _LANES)
    return source.mapInArrow(run, f"{columns}, n bigint, id bigint, {bits}, token bigint, times bigint")


class Order:
    """Global orders of tokens: frequent ones last, by how often they were met, others by a hash."""

    def __init__(self, tokens: np.ndarray, times: np.ndarray):
        self.tokens = tokens.astype(np.uint64)
        self.ranks = np.minimum(np.log2(np.maximum(times, 1)) * 8 + 1, 255).astype(np.uint64)

    def keys(self, tokens: np.ndarray, order: int) -> np.ndarray:
        """52-bit sort keys of the tokens under one order."""
        rank = np.zeros(len(tokens), np.uint64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            rank = np.where(self.tokens[at] == tokens, self.ranks[at], rank)
        return rank << np.uint64(44) | mix(tokens ^ _SEEDS[order]) >> np.uint64(20)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of n of which a partner must hold one: all but the share it may miss, and one more."""
    return n - (n * percent + 99) // 100 + 1


def _postings(source: DataFrame, order, width: int, percent: int) -> DataFrame:
    """``key`` (token), ``id``: the prefix of every distinct set under the first order."""
    ship(source.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for block in blocks(batches):
            tokens, owner = shingles(*flat(block.column("text")), width)
            bounds = row_bounds(owner, block.num_rows)
            ids = set_ids(tokens, bounds)
            keep = _new(ids, seen)[owner]
            tokens, owner = tokens[keep], owner[keep]
            by = np.argsort(owner.astype(np.uint64) << np.uint64(52) | order.value.keys(tokens, 0))
            tokens, owner = tokens[by], owner[by]
            bounds = row_bounds(owner, block.num_rows)
            take = np.arange(len(tokens)) - bounds[owner] < prefix_length(np.diff(bounds), percent)[owner]
            yield batch(key=longs(tokens[take]), id=longs(ids[owner[take]]))
    return source.select("text").mapInArrow(run, "key bigint, id bigint")


def _sets(source: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id``, ``tokens`` of the distinct sets that ``wanted`` (``id``) names."""
    ship(source.sparkSession)
    small = fits_broadcast(wanted, max_rows=2 * TABLE_ENTRIES)[1]
    names = shared(source.sparkSession, table(wanted, 2 * TABLE_ENTRIES)["id"] if small else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for block in blocks(batches):
            tokens, owner = shingles(*flat(block.column("text")), width)
            bounds = row_bounds(owner, block.num_rows)
            ids = set_ids(tokens, bounds)
            keep = _new(ids, seen)
            if names.value is not None:
                keep &= np.isin(ids.view(np.int64), names.value)
            tokens = tokens[keep[owner]]
            ends = np.concatenate([[0], np.cumsum(np.diff(bounds)[keep])])
            yield batch(id=longs(ids[keep]), tokens=lists(longs(tokens), ends))
    found = source.select("text").mapInArrow(run, "id bigint, tokens array<bigint>")
    if not small:
        found = found.join(wanted, "id", "left_semi")
    return found.dropDuplicates(["id"])


def _verified(pairs: DataFrame, sets: DataFrame, order, percent: int, orders: int) -> DataFrame:
    """Pairs that share a prefix token under every order and whose sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def prefixes(tokens: np.ndarray) -> list[np.ndarray]:
        length = int(prefix_length(np.array([len(tokens)]), percent)[0])
        return [tokens[np.argsort(order.value.keys(tokens, k))[:length]] for k in range(1, orders)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for rows in batches:
            ids = {s: rows.column(s).to_pylist() for s in "ab"}
            values = {s: rows.column(t).flatten().to_numpy().view(np.uint64) for s, t in (("a", "x"), ("b", "y"))}
            ends = {s: np.concatenate([[0], np.cumsum(rows.column(t).value_lengths().to_numpy())])
                    for s, t in (("a", "x"), ("b", "y"))}
            keep = np.zeros(rows.num_rows, bool)
            for i in range(rows.num_rows):
                side = []
                for s in "ab":
                    name = ids[s][i]
                    if name not in known:
                        if len(known) > 256:
                            known.clear()
                        tokens = values[s][ends[s][i]:ends[s][i + 1]]
                        known[name] = tokens, prefixes(tokens)
                    side.append(known[name])
                (x, px), (y, py) = side
                if all(len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(px, py)):
                    both_ = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * both_ >= percent * (len(x) + len(y) - both_)
            yield batch(a=rows.column("a"), b=rows.column("b")).filter(pa.array(keep))
    return both.mapInArrow(run, "a bigint, b bigint")


def _versus(faced: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``center``, ``id``, ``linked``, and how the two sets lie: ``both`` (common tokens), ``differ`` (tokens of one
    only), 1,024 bits: which of 1,024 buckets those fall into, and ``around`` (tokens of the center)."""
    tokens = faced.join(sets.select("id", F.col("tokens").alias("x")), "id")
    middle = faced.select(F.col("center").alias("id")).distinct().join(sets, "id").toDF("center", "y")
    joined = lookup_join(tokens, materialize(middle, "middle"), ["center"], "inner").select("center", "id", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            values = {t: rows.column(t).flatten().to_numpy().view(np.uint64) for t in "xy"}
            ends = {t: np.concatenate([[0], np.cumsum(rows.column(t).value_lengths().to_numpy())]) for t in "xy"}
            n = rows.num_rows
            both, differ, cells = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, _CELLS), np.uint8)
            for i in range(n):
                x, y = (values[t][ends[t][i]:ends[t][i + 1]] for t in "xy")
                odd = np.setxor1d(x, y, assume_unique=True)
                differ[i] = len(odd)
                both[i] = (len(x) + len(y) - len(odd)) // 2
                cells[i, (mix(odd ^ _SEEDS[4]) >> np.uint64(64 - 10)).astype(np.int64)] = 1
            words = np.packbits(cells, axis=1, bitorder="little").view(np.uint64)
            around = np.diff(ends["y"])
            linked = 100 * both >= percent * (np.diff(ends["x"]) + around - both)
            yield batch(center=rows.column("center"), id=rows.column("id"), linked=pa.array(linked),
                        both=pa.array(both), differ=pa.array(differ), around=pa.array(around, pa.int64()),
                        **{c: longs(words[:, i]) for i, c in enumerate(_MARKS)})
    marks = ", ".join(f"{c} bigint" for c in _MARKS)
    return joined.mapInArrow(run, f"center bigint, id bigint, linked boolean, both bigint, differ bigint, around bigint, {marks}")


def components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, orders: int = ORDERS,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """Classes of documents whose sets of ``width``-word shingles are linked by Jaccard >= ``percent`` / 100.

    Equal sets are one node. Under each global order of tokens a linked pair shares a token of both
    prefixes, so a candidate must do so under all of them: the first order (rare tokens first) finds
    pairs through the tokens they share, the count of shared prefix tokens must leave room for the
    overlap they need, 512 parity bits per set must not differ more than linked sets can, and the
    other orders are asked before the sets are compared.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (least ``doc_id`` of the class), ``set_id``; one row per input
    row. Null or empty text, or no words: 0 shingles, linked with nothing, its own component. Null ids:
    members of their class, whose least id is that of another row, or null. Repeated rows: kept. Other
    columns are not read. Empty table: empty result. Shingles are told apart by 52 bits inside a
    document and sets by 64 bits.
    """
    rows = classes(texts(docs, key, text), width, percent, orders)
    first = materialize(rows.filter("id <> 0").groupBy("label").agg(F.min("doc_id").alias("component_id")), "firsts")
    out = rows.filter("id <> 0").join(first, "label")
    alone = rows.filter("id = 0").withColumn("component_id", F.col("doc_id"))
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                         F.col("id").alias("set_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, orders: int = ORDERS,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of :func:`components`: the one of least id (null last); all columns as they are.

    Rows without words are in no class and all stay. Of repeated rows (equal id and text) with words one stays.
    """
    own, body = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    mark = F.xxhash64(F.lit(7), own, body)
    rows = classes(texts(docs, key, text).withColumn("mark", F.xxhash64(F.lit(7), "doc_id", "text")),
                   width, percent, orders).filter("id <> 0")
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark")
    name = fresh(docs, "__mark")
    heads = materialize(rows.groupBy("label").agg(F.min(place).alias("head")).select(F.col("head.mark").alias(name)),
                        "heads")
    worded = F.coalesce(body.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    best = docs.filter(worded).withColumn(name, mark).join(heads, name, "left_semi").dropDuplicates([name])
    return best.select(*docs.columns).unionByName(docs.filter(~worded))


def classes(source: DataFrame, width: int, percent: int, orders: int) -> DataFrame:
    """Each row of ``source`` without its text, with ``n`` (shingles), ``id`` (its set, 0 if empty) and ``label`` (class)."""
    spark = source.sparkSession
    scanned = materialize(rows_and_tokens(source, width), "sets")
    nodes = scanned.filter("id <> 0").groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", *_LANES)])
    times = materialize(scanned.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times")), "times")
    often = table(times.filter(F.col("times") >= frequent(times, "times")))
    order = shared(spark, Order(often["token"].view(np.uint64), often["times"]))
    postings = _postings(source, order, width, percent)  # read twice: cheaper than writing all of them
    least = postings.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi")
    least = materialize(least.select("key", "lo"), "keys")
    met = postings.join(least, "key").filter("id <> lo").select("key", "id", "lo")
    nodes = materialize(nodes, "nodes")

    def room(x: Column, y: Column, common: Column) -> Column:
        """Whether two sets may be linked that share ``common`` tokens of their prefixes: what lies beyond
        the prefix that ends first can add no more than its length."""
        need = F.ceil((x + y) * percent / (100 + percent) - 1e-9)
        rest = F.greatest(F.floor((x * percent + 99) / 100), F.floor((y * percent + 99) / 100)) - 1
        return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (common + rest >= need)

    def near(left: str, right: str) -> Column:
        """Whether the bits of two sets allow for as few different tokens as linked sets have."""
        x, y = F.col(left + "n"), F.col(right + "n")
        apart = reduce(Column.__add__, [F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in _LANES])
        return apart <= x + y - 2 * F.ceil((x + y) * percent / (100 + percent) - 1e-9)

    def plausible(pairs: DataFrame) -> DataFrame:
        both = pairs
        for side in ("a", "b"):
            both = both.join(nodes.toDF(side, *[f"{side}_{c}" for c in ("n", *_LANES)]), side)
        return both.filter(room(F.col("a_n"), F.col("b_n"), F.col("shared")) & near("a_", "b_")).select("a", "b")

    def facts(members: DataFrame) -> DataFrame:
        """Size of each set, and how many tokens of its prefix it shares with any other prefix."""
        return members.groupBy("id").agg(F.count("*").alias("common")).join(nodes, "id")

    def possible(left: str, right: str) -> Column:
        common = F.least(left + "common", right + "common")
        return room(F.col(left + "n"), F.col(right + "n"), common) & near(left, right)

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = materialize(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
                             .distinct(), "wanted")
        sets = materialize(_sets(source, wanted, width), "tokens")
        return _verified(pairs, sets, order, percent, orders)

    def versus(faced: DataFrame) -> DataFrame:
        wanted = materialize(faced.select("id").unionByName(faced.select(F.col("center").alias("id"))).distinct(), "wanted")
        return _versus(faced, materialize(_sets(source, wanted, width), "tokens"), percent)

    def apart(left: str, right: str) -> Column:
        """Whether two sets may have as many tokens in common as a link needs: those that both have of the
        center's, less what each lacks, and those of their differences from it that may be the same."""
        x, y = F.col(left + "n"), F.col(right + "n")
        need = F.ceil((x + y) * percent / (100 + percent) - 1e-9)

        def alike(one: str, other: str) -> Column:
            alone = [F.bit_count(F.col(one + c).bitwiseAND(F.bitwise_not(F.col(other + c)))) for c in _MARKS]
            return F.col(one + "differ") - reduce(Column.__add__, alone)
        same = F.least(alike(left, right), alike(right, left))
        return F.col(left + "both") + F.col(right + "both") - F.col(left + "around") + same >= need

    labels = linking.classes(met, verify, plausible, facts, possible, versus, apart)
    rows = scanned.filter("id is not null").drop("token", "times", *_LANES)
    named = rows.join(labels.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    return materialize(named.withColumn("label", F.coalesce("label", "id")).drop("of"), "classes")
