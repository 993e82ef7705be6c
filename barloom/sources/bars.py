"""Reading and writing bar tables in the hive layout interval=.../symbol=... ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR = T.StructType([
    T.StructField("ts", T.TimestampType()), *(T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")), T.StructField("volume", T.LongType()),
    T.StructField("vwap", T.DoubleType()), T.StructField("n_trades", T.LongType()), T.StructField("symbol", T.StringType()), T.StructField("interval", T.StringType()),
])
#: Columns that a sink never narrows.
BASE = ("open", "high", "low", "close", "volume", "vwap", "n_trades")


def scan_bars(spark: SparkSession, root: str, symbols: list[str] | None = None, interval: str | None = None) -> DataFrame:
    """The bars under root; symbols and interval prune partitions."""
    df = spark.read.schema(BAR).parquet(root)
    if interval is not None:
        df = df.where(F.col("interval") == interval)
    return df if symbols is None else df.where(F.col("symbol").isin(symbols))


def load_panel(bars: DataFrame, rows_per_symbol: int) -> DataFrame:
    """The most recent rows of each symbol; rows without a time go. Spark keeps no more than that of a symbol before the shuffle."""
    w = Window.partitionBy("symbol").orderBy(F.desc("ts"))
    return bars.where(F.col("ts").isNotNull()).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows_per_symbol).drop("_rn")


def load_report(bars: DataFrame, asked: DataFrame) -> DataFrame:
    """asked(symbol): how many rows each has, and loaded or file_not_found."""
    found = bars.groupBy("symbol").agg(F.count("*").alias("n_rows"))
    return asked.join(found, "symbol", "left").select("symbol", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(F.col("n_rows").isNull(), "file_not_found").otherwise("loaded").alias("status"))


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header, read in splits against a given schema; a row that doesn't fit it is an error."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def narrowed(df: DataFrame) -> DataFrame:
    """Double features as floats, and whole-number features as ints where all their values fit, found in one pass; base columns untouched."""
    wide = [c for c, t in df.dtypes if t == "bigint" and c not in BASE]
    least = -(1 << 31)
    fits = df.agg(*(F.coalesce((F.min(c) >= least) & (F.max(c) < -least), F.lit(False)).alias(c) for c in wide)).first() if wide else {}
    kind = {c: "float" for c, t in df.dtypes if t == "double" and c not in BASE} | {c: "int" for c in wide if fits[c]}
    return df.select(*(F.col(c).cast(kind[c]).alias(c) if c in kind else F.col(c) for c in df.columns))


def checked(df: DataFrame, required: tuple[str, ...] = ("symbol", "ts", "open", "high", "low", "close", "volume")) -> DataFrame:
    """The frame itself, if it has these columns and a row; otherwise ValueError."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if df.isEmpty():
        raise ValueError("no rows to write")
    return df


def write_bars(df: DataFrame, root: str, interval: str, zone: str = "America/New_York", mode: str = "overwrite", by_date: bool = True) -> None:
    """Partitioned by interval, symbol and, if asked for, the local date, which suits bars of many a day; dynamic, so a rerun replaces only the
    partitions that it has. Rows meet by partition before they are written, so each one is few files."""
    held = checked(df).withColumn("interval", F.lit(interval))
    keys = ["symbol"]
    if by_date:
        held, keys = held.withColumn("date", F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone))), ["symbol", "date"]
    held.repartition(*keys).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("interval", *keys).parquet(root)


def without_targets(df: DataFrame, prefixes: tuple[str, ...] = ("y_", "fwd_ret", "tth", "mfe", "mdd", "hit_", "ret_ord")) -> DataFrame:
    """The columns that no label family owns, so labels can be made anew."""
    return df.select(*(c for c in df.columns if not c.startswith(prefixes)))


def not_done(df: DataFrame, root: str) -> DataFrame:
    """The rows of symbols that root doesn't hold yet; all of them where nothing is written."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return df
    done = spark.read.parquet(root).select(F.col("symbol").cast("string").alias("symbol")).distinct()
    return df.join(done, "symbol", "left_anti")


def write_labels(df: DataFrame, root: str, version: str, about: dict[str, str]) -> None:
    """df under labels/label_version=..., replacing that version alone, and a row about it under versions."""
    spark = df.sparkSession
    held = df.withColumn("label_version", F.lit(version))
    held.repartition("symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("label_version").parquet(f"{root}/labels")
    row = spark.range(1).select(F.lit(version).alias("label_version"), F.current_timestamp().alias("made_at"), *(F.lit(v).alias(k) for k, v in about.items()))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("label_version").parquet(f"{root}/versions")
