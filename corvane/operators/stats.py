"""Aggregates and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.rouge import rouge
from corvane.scale import Ordered


def chunk_stats(chunks: DataFrame, key: str = "doc_id", chunk: str = "chunk") -> DataFrame:
    """Chunks and mean chunk length per source."""
    size = F.length(chunk)
    return chunks.groupBy(key).agg(
        F.count("*").alias("n_chunks"),
        F.avg(size).alias("mean_length"))


def size_report(df: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Number of rows and mean length of the whole set."""
    size = F.length(chunk)
    return df.agg(F.count("*").alias("n_rows"),
                  F.avg(size).alias("mean_length"))


def value_counts(df: DataFrame, name: str, normalize: bool = False) -> DataFrame:
    counts = df.groupBy(name).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    total = df.agg(F.count("*").alias("c")).scalar()
    return counts.select(name, (F.col("n") / total).alias("share"))


def centroid(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.avg(x).alias("x"), F.avg(y).alias("y"))


def union_sets(df: DataFrame, key: str, value: str, out: str = "members") -> DataFrame:
    """Sorted distinct values per key; duplicates are dropped before the shuffle."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(out))


def metric_means(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(n).alias(n) for n in names])


def rouge_means(pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Means of ROUGE-1, -2, -L and -Lsum over all pairs, in one row, from one pass over them."""
    names = ["rouge1", "rouge2", "rougeL", "rougeLsum"]
    return metric_means(rouge(pairs, key, names), names)


def last_entry(df: DataFrame, order: Sequence[str], cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Columns of the last row by ``order``, overall or per key."""
    last = F.max_by(F.struct(*cols), F.struct(*order)).alias("__last")
    return df.groupBy(*by).agg(last).select(*by, "__last.*")


def last_metric(df: DataFrame, step: str, metric: Column, default: str = "No metrics available") -> DataFrame:
    """Text of the last log entry, or the default sentence for an empty log."""
    return df.agg(F.coalesce(F.max_by(metric, F.col(step)), F.lit(default)).alias("last_metric"))


def latest_version(df: DataFrame, name: str, prefix: str = "checkpoint-", by: Sequence[str] = ()) -> DataFrame:
    """Name with the largest numeric suffix among those with the prefix; null when there is none."""
    named = F.when(F.col(name).startswith(prefix), F.col(name))
    number = F.element_at(F.split(F.substring(named, len(prefix) + 1, 2 ** 30), "-"), 1).try_cast("bigint")
    return df.groupBy(*by).agg(F.max_by(named, number).alias("latest"))


def profile(df: DataFrame, ids: str, pad_id: int) -> DataFrame:
    """Rows, shortest and longest id list, share of rows that hold padding."""
    return df.agg(
        F.count("*").alias("n_rows"), F.min(F.size(ids)).alias("min_len"), F.max(F.size(ids)).alias("max_len"),
        F.avg(F.array_contains(ids, pad_id).cast("int")).alias("padded_share"))


def minmax(df: DataFrame, name: str, out: str = "scaled") -> DataFrame:
    """Scale to [0, 1], 4 places; extremes come from one aggregate used as a scalar subquery."""
    lo = df.agg(F.min(name).alias("m")).scalar()
    span = df.agg((F.max(name) - F.min(name)).alias("m")).scalar()
    return df.withColumn(out, F.when(span == 0, F.lit(0.0)).otherwise(F.round((F.col(name) - lo) / span, 4)))


def mirrored(df: DataFrame, value: str, scaled: str) -> DataFrame:
    """The table followed by its negated copy."""
    return df.unionByName(df.withColumns({value: -F.col(value), scaled: 0.0 - F.col(scaled)}))


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, classes: Sequence[int]) -> DataFrame:
    """Rows per class ``y`` by prediction; ``pred_other`` counts predictions outside ``classes``, null ones too."""
    cells = [F.sum(F.when(F.col(yhat) == c, 1).otherwise(0)).alias(f"pred_{c}") for c in classes]
    known = F.coalesce(F.col(yhat).isin(list(classes)), F.lit(False))
    cells.append(F.sum(F.when(known, 0).otherwise(1)).alias("pred_other"))
    return df.groupBy(F.col(y).alias("y")).agg(*cells)


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def class_scores(df: DataFrame, y: str, yhat: str, beta: float = 1.0) -> DataFrame:
    """Precision, recall, F-beta and support per class, from one pass over the rows."""
    sides = confusion(df, y, yhat).select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("yhat").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    sums = sides.groupBy("c").agg(F.sum("hit").alias("hit"), F.sum("predicted").alias("predicted"),
                                  F.sum("support").alias("support"))
    p, r = _ratio(F.col("hit"), F.col("predicted")), _ratio(F.col("hit"), F.col("support"))
    b2 = beta * beta
    scored = sums.select("c", "hit", "support", p.alias("precision"), r.alias("recall"))
    f = _ratio((1 + b2) * F.col("precision") * F.col("recall"), b2 * F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f)


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Per-class rows, then accuracy, macro average and support-weighted average."""
    scores = class_scores(df, y, yhat)
    names = ("precision", "recall", "f1")
    per_class = scores.select(F.col("c").cast("string").alias("label"), *names, "support")
    total = F.sum("support")
    accuracy = F.sum("hit") / total
    summary = scores.agg(
        accuracy.alias("acc"), total.alias("support"),
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[(F.sum(F.col(n) * F.col("support")) / total).alias(f"weighted_{n}") for n in names])
    rows = [F.struct(F.lit("accuracy").alias("label"), *[F.col("acc").alias(n) for n in names], "support")]
    rows += [F.struct(F.lit(f"{kind} avg").alias("label"),
                      *[F.col(f"{kind}_{n}").alias(n) for n in names], "support")
             for kind in ("macro", "weighted")]
    return per_class.unionByName(summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))


def balanced_accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return class_scores(df, y, yhat).filter("support > 0").agg(F.avg("recall").alias("balanced_accuracy"))


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sums; ties count half.

    Rows are first reduced to one per distinct score, then a running count over the
    score order gives the negatives below each score.
    """
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(y) == 1).cast("bigint")).alias("pos"), F.sum((F.col(y) == 0).cast("bigint")).alias("neg"))
    ranked = Ordered(per_score, [], ["score"]).running(inclusive=False, below=F.col("neg")).result()
    return ranked.agg(
        (F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def material_by(df: DataFrame, key: str, weight: Column) -> DataFrame:
    """Sum of signed symbol weights per key."""
    return df.groupBy(key).agg(F.sum(weight).alias("score"))
