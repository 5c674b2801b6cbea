"""Table readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.arrays import curve, gaussian
from corvane.scale import uniform


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """JSON lines, or whole-file arrays with ``multiline``; the schema is inferred when not given."""
    reader = spark.read.option("multiLine", str(multiline).lower())
    return (reader.schema(schema) if schema is not None else reader).json(path)


def flatten_records(df: DataFrame, name: str, schema: str) -> DataFrame:
    """Rows of a JSON object of objects: its key as ``key`` and the fields of each value."""
    parsed = F.from_json(name, f"map<string, {schema}>")
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(parsed).alias("key", "__v")).select(*rest, "key", "__v.*")


def part_after(col: Column, sep: str, position: int) -> Column:
    """The ``position``-th piece of each item of an array of strings; negative counts from the end."""
    return F.transform(col, lambda x: F.try_element_at(F.split(x, sep), F.lit(position)))


def flatten_stations(df: DataFrame, name: str) -> DataFrame:
    """Raw station records as (station, name, number, line, lat, lon)."""
    raw = flatten_records(df, name, "struct<title string, lines array<string>, "
                                    "location struct<latitude string, longitude string>>")
    return raw.select(
        *[c for c in df.columns if c != name], F.col("key").alias("station"), F.col("title").alias("name"),
        part_after(F.col("lines"), "-", 2).alias("number"), part_after(F.col("lines"), "-", -1).alias("line"),
        F.col("location.latitude").try_cast("double").alias("lat"),
        F.col("location.longitude").try_cast("double").alias("lon"))


def export(df: DataFrame, path: str, fmt: str) -> None:
    """CSV or JSON copy of a table; in CSV, nested columns are written as JSON text."""
    if fmt == "json":
        df.write.json(path)
        return
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt}")
    nested = {f.name: F.to_json(f.name) for f in df.schema
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    flat = df.withColumns(nested) if nested else df
    flat.write.option("header", "true").option("escape", '"').csv(path)


def save_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load(spark: SparkSession, root: str, name: str, split: str | None = None) -> DataFrame:
    """Named data set, or one split of it; the split is a partition, so others are not read."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    return df if split is None else df.filter(F.col("split") == split)


def synth_columns(df: DataFrame, key: str, seed: int, informative: int = 4, features: int = 9) -> DataFrame:
    """Add x0.. and y to rows with a unique key.

    y is 1 with probability 0.25. The first ``informative`` features depend on y, the
    others are noise, and x4 is then a noisy curve of a uniform value. Every value
    hashes the key, so it does not depend on partitioning.
    """
    def normal(i: int) -> Column:
        return gaussian(uniform(key, seed=seed + 2 * i), uniform(key, seed=seed + 2 * i + 1))

    out = df.withColumn("y", (uniform(key, seed=seed - 1) < 0.25).cast("int"))
    cols = {f"x{i}": normal(i) + (F.col("y") - 0.5 if i < informative else 0.0) for i in range(features)}
    x = uniform(key, seed=seed + 100) * 20.0 - 10.0
    cols["x4"] = curve(x) + 0.5 * normal(101)
    return out.withColumns(cols)


def synth(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """``n`` generated rows: x0..x8 and y."""
    return synth_columns(spark.range(n), "id", seed).drop("id").select(*[f"x{i}" for i in range(9)], "y")
