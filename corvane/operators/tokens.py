"""Vocabulary, fixed-length encoding, batches and collation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.scale import BROADCAST_ROWS, fits_broadcast, global_index, limit, lookup_join, materialize

# Reserved ids and the label value that training ignores.
UNK_ID, EOS_ID, FIRST_ID = 0, 2, 3
IGNORE = -100
SHORT_BYTES = 64  # longest token of the broadcast head, so that its size is bounded
SPECIALS = ("<|im_start|>", "<|im_end|>")


def build_vocab(df: DataFrame, specials: Sequence[str] = SPECIALS, text: str = "text",
                first_id: int = FIRST_ID) -> DataFrame:
    """Tokens with ids by (count descending, token); missing specials follow, marked ``added``."""
    counts = (df.select(F.explode(tx.words(F.col(text))).alias("token"))
              .groupBy("token").agg(F.count("*").alias("n")))
    counts = materialize(counts.select((-F.col("n")).alias("__rank"), "token"), "vocab")
    ranked = global_index(counts, ["__rank", "token"], "__ix").select(
        "token", (-F.col("__rank")).alias("n"), (F.col("__ix") + first_id).cast("bigint").alias("id"),
        F.lit(False).alias("added"))
    if not specials:
        return ranked
    spark = df.sparkSession
    listed = spark.createDataFrame([(s, i) for i, s in enumerate(specials)], "token string, __p int")
    missing = listed.join(counts.filter(F.col("token").isin(list(specials))), "token", "left_anti")
    size = counts.agg(F.count("*").alias("c")).scalar()
    place = F.row_number().over(Window.orderBy("__p")) - 1
    extra = missing.select("token", F.lit(0).cast("bigint").alias("n"),
                           (size + place + first_id).cast("bigint").alias("id"), F.lit(True).alias("added"))
    return ranked.unionByName(extra)


def _padded(ids: Column, fill: Column, width: Column, side: str) -> Column:
    pads = F.array_repeat(fill, (width - F.size(ids)).cast("int"))
    return F.concat(pads, ids) if side == "left" else F.concat(ids, pads)


def _looked_up(df: DataFrame, vocab: DataFrame, key: Sequence[str], unk_id: int) -> DataFrame:
    """Ids of the word lists in ``__tokens``, from a vocabulary that every task holds."""
    known = vocab.toArrow()
    held = df.sparkSession.sparkContext.broadcast(
        (known.column("token").combine_chunks(), known.column("id").cast(pa.int32()).combine_chunks()))

    def run(batches):
        words, ids = held.value
        for batch in batches:
            lists = batch.column("__tokens")
            found = ids.take(pc.index_in(lists.flatten().cast(words.type), value_set=words)).fill_null(unk_id)
            ends = pa.concat_arrays([pa.array([0], pa.int32()),
                                     pc.cumulative_sum(lists.value_lengths().fill_null(0)).cast(pa.int32())])
            columns = [batch.column(k) for k in key] + [pa.ListArray.from_arrays(ends, found)]
            yield pa.RecordBatch.from_arrays(columns, [*key, "input_ids"])
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    return df.mapInArrow(run, f"{kinds}, input_ids array<int>")


def _head_and_rare(df: DataFrame, head: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ids of the words in ``__tokens`` that ``head`` knows, null for the others; those in ``__rare``, in their order."""
    known = head.toArrow()
    held = df.sparkSession.sparkContext.broadcast(
        (known.column("token").combine_chunks(), known.column("id").cast(pa.int32()).combine_chunks()))

    def run(batches):
        words, ids = held.value
        for batch in batches:
            lists = batch.column("__tokens")
            tokens = lists.flatten().cast(words.type)
            found = ids.take(pc.index_in(tokens, value_set=words))
            rare = pc.is_null(found)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            before = np.concatenate([[0], np.cumsum(rare.to_numpy(zero_copy_only=False))])
            columns = [batch.column(k) for k in key]
            columns += [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found),
                        pa.ListArray.from_arrays(pa.array(before[bounds], pa.int32()), tokens.filter(rare))]
            yield pa.RecordBatch.from_arrays(columns, [*key, "input_ids", "__rare"])
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    return df.mapInArrow(run, f"{kinds}, input_ids array<int>, __rare array<string>")


def _filled(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``input_ids`` with its nulls replaced by ``__ids``, in their order."""
    def run(batches):
        for batch in batches:
            lists = batch.column("input_ids")
            values, more = lists.flatten(), batch.column("__ids").flatten()
            values = pc.replace_with_mask(values, pc.is_null(values), more)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            columns = [batch.column(k) for k in key] + [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)]
            yield pa.RecordBatch.from_arrays(columns, [*key, "input_ids"])
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    return df.mapInArrow(run, f"{kinds}, input_ids array<int>")


def _looked_up_beyond(df: DataFrame, table: DataFrame, head: int, key: Sequence[str], unk_id: int) -> DataFrame:
    """Ids of the word lists in ``__tokens`` from a vocabulary of any size: only words outside its head are shuffled."""
    edge = table.agg(F.min("id")).first()[0] + head
    frequent = (F.col("id") < edge) & (F.octet_length("token") <= SHORT_BYTES)
    near = _head_and_rare(df, table.filter(frequent), key).withColumn("__row", F.monotonically_increasing_id())
    near = materialize(near, "near")  # the row numbers are fixed by writing them
    rare = near.select("__row", F.posexplode("__rare").alias("__pos", "token"))
    found = lookup_join(rare, table.filter(~frequent), ["token"], fits=False)
    item = F.struct("__pos", F.coalesce("id", F.lit(unk_id)).cast("int").alias("id"))
    more = found.groupBy("__row").agg(F.array_sort(F.collect_list(item)).alias("__items")) \
        .select("__row", F.transform("__items", lambda x: x["id"]).alias("__ids"))
    whole = near.filter(F.size("__rare") == 0).select(*key, "input_ids")
    open_ = near.filter(F.size("__rare") > 0).drop("__rare").join(more, "__row")
    return whole.unionByName(_filled(open_.select(*key, "input_ids", "__ids"), key))


def encode(df: DataFrame, vocab: DataFrame, length: int, side: str | None = "right",
           pad_id: int = EOS_ID, unk_id: int = UNK_ID, text: str = "text",
           key: Sequence[str] = ("doc_id",), head: int | None = None, cut: bool = True) -> DataFrame:
    """Token ids cut to ``length`` and padded, with mask and labels; ``side=None`` does not pad.

    Without ``cut`` a text of more tokens keeps them all, in a longer row.

    ``vocab`` is ordered by frequency, as ``build_vocab`` returns it. One that is measured to
    fit a broadcast is looked up inside each row, without a shuffle. A larger one is cut: its
    ``head`` most frequent short tokens are looked up inside each row too, and only rare or very long
    tokens are shuffled to their ids and back to their rows. Tokens beyond ``length`` never leave the scan stage, unless ``cut`` is off.
    """
    head = limit(df.sparkSession, "broadcastRows", BROADCAST_ROWS, head)
    tokens = F.slice(tx.words(F.col(text)), 1, length) if cut else tx.words(F.col(text))
    table = vocab.select("token", "id")
    if fits_broadcast(table, head)[1]:
        ids = _looked_up(df.select(*key, tokens.alias("__tokens")), table, key, unk_id)
    else:
        ids = _looked_up_beyond(df.select(*key, tokens.alias("__tokens")), table, head, key, unk_id)
    if side is None:
        return ids
    col, width = F.col("input_ids"), F.lit(length)
    return ids.select(
        *key, _padded(col, F.lit(pad_id), width, side).alias("input_ids"),
        _padded(F.transform(col, lambda x: F.lit(1)), F.lit(0), width, side).alias("attention_mask"),
        _padded(col, F.lit(pad_id), width, side).alias("labels"))


def assign_batches(df: DataFrame, order: Sequence[str], size: int, accumulation: int = 1) -> DataFrame:
    """Batch and optimizer-step numbers in the total order of ``order``."""
    placed = global_index(df, order, "__ix")
    return placed.withColumns({
        "batch": F.expr(f"__ix div {size}"),
        "step": F.expr(f"__ix div {size * accumulation}")}).drop("__ix")


def _batch_width(df: DataFrame, batch: str, ids: str) -> Column:
    return F.max(F.size(ids)).over(Window.partitionBy(batch))


def pad_to_longest(df: DataFrame, batch: str, ids: str = "input_ids", pad_id: int = EOS_ID,
                   side: str = "right") -> DataFrame:
    """Pad every row to the longest row of its batch; a batch is a fixed number of rows."""
    wide = df.withColumn("width", _batch_width(df, batch, ids))
    return wide.withColumn(ids, _padded(F.col(ids), F.lit(pad_id), F.col("width"), side))


def collate(df: DataFrame, batch: str, multiple: int = 8, ids: str = "input_ids",
            pad_id: int = EOS_ID) -> DataFrame:
    """Pad to the batch maximum rounded up to ``multiple``; labels ignore the padding id."""
    longest = _batch_width(df, batch, ids)
    wide = df.withColumn("width", (F.ceil(longest / multiple) * multiple).cast("int"))
    padded = wide.withColumn(ids, _padded(F.col(ids), F.lit(pad_id), F.col("width"), "right"))
    return padded.withColumn("labels", F.transform(
        ids, lambda x: F.when(x == pad_id, IGNORE).otherwise(x)))
