"""Bars in files that don't agree on their types: whole prices here, floating ones there, times as numbers or texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.bars import BAR
from barloom.sources.times import as_time

#: What names a bar's partition: told by the folders, never by the files.
PARTITIONS = ("symbol", "interval")
MOST_KINDS = 256
POLICIES = ("coerce", "separate", "strict", "quarantine")


def _footers(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.fs
    import pyarrow.parquet

    for part in parts:
        kinds = []
        for uri in part["path"]:
            system, path = pyarrow.fs.FileSystem.from_uri(uri)
            kinds.append("\n".join(f"{f.name}\t{f.type}" for f in pyarrow.parquet.read_schema(path, filesystem=system)))
        yield pd.DataFrame({"path": part["path"], "kind": kinds})


def physical_kinds(spark: SparkSession, root: str) -> DataFrame:
    """(path, kind) of every parquet file under root; files with the same columns of the same types in the same order are of one kind.

    Files are listed without their contents, and tasks read the footers alone, a few kB a file, through Arrow's file systems: local paths and the stores
    that Arrow can open by their URI."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path")
    return files.mapInPandas(_footers, "path string, kind string")


def _read_kind(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Files of one kind as they are, with their partitions as text, so that 007 stays 007."""
    held = [f for f in spark.read.parquet(paths[0]).schema if f.name not in PARTITIONS]
    folders = [p for p in PARTITIONS if f"/{p}=" in paths[0]]
    schema = T.StructType([*held, *(T.StructField(p, T.StringType()) for p in folders)])
    return spark.read.option("basePath", root).schema(schema).parquet(*paths)


def _whole(number: Column) -> Column:
    """Rounded to a whole number, halves away from zero; null where it is no number or has no place in 64 bits."""
    n = number.try_cast("double")
    return F.when(F.abs(n) < 9.2e18, F.round(n).cast("long"))


def _canonical(df: DataFrame) -> DataFrame:
    """The columns of BAR in its types and volume_raw; columns that the files lack are null, others go."""
    kinds = {f.name: f.dataType for f in df.schema}
    shown = []
    for f in BAR:
        if f.name not in kinds:
            shown.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "ts":
            shown.append(as_time("ts", kinds["ts"]).alias("ts"))
        elif isinstance(f.dataType, T.LongType):
            exact = isinstance(kinds[f.name], T.IntegralType)
            shown.append((F.col(f.name).cast("long") if exact else _whole(F.col(f.name))).alias(f.name))
        else:
            shown.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    raw = F.col("volume").try_cast("double") if "volume" in kinds else F.lit(None).cast("double")
    return df.select(*shown, raw.alias("volume_raw"))


def scan_mixed(spark: SparkSession, root: str, symbols: list[str] | None = None, interval: str | None = None) -> DataFrame:
    """All bars under root in the types of BAR, and volume_raw, the volume as a double before it was rounded.

    Files of one kind are one scan, and scans are put together by name: the plan has a branch a kind, not a file (more than MOST_KINDS kinds are an
    error). Times are read as times.as_time does, numbers that are no numbers are null. symbols and interval prune folders of every scan. A root without
    parquet files is FileNotFoundError."""
    kinds: dict[str, list[str]] = {}
    for row in physical_kinds(spark, root).toLocalIterator():  # names of files, which Spark's own listing holds on the driver too
        kinds.setdefault(row["kind"], []).append(row["path"])
    if not kinds:
        raise FileNotFoundError(f"no parquet files under {root}")
    if len(kinds) > MOST_KINDS:
        raise ValueError(f"{len(kinds)} kinds of files under {root}, more than {MOST_KINDS}")
    scans = []
    for kind in sorted(kinds):
        df = _read_kind(spark, root, sorted(kinds[kind]))
        if interval is not None and "interval" in df.columns:
            df = df.where(F.col("interval") == interval)
        if symbols is not None and "symbol" in df.columns:
            df = df.where(F.col("symbol").isin(symbols))
        scans.append(_canonical(df))
    out = scans[0]
    for df in scans[1:]:
        out = out.unionByName(df)
    return out


def volume_policy(bars: DataFrame, policy: str, within: float = 0.05) -> DataFrame:
    """bars(volume_raw, ...) with volume by a policy about fractional volumes; a null or infinite volume is null and never a fraction.

    coerce: rounded where that changes it by `within` at most, else the read fails. separate: the whole part, and volume_adj, what is left of it. strict: any
    fraction fails the read. quarantine: volume is null where it has a fraction, and quarantined says so, so that two filters give either part."""
    raw = F.when(F.abs("volume_raw") < 9.2e18, F.col("volume_raw"))
    off = F.abs(raw - F.round(raw))
    fails = lambda bad, what: F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(F.lit(f"{what}: "), raw.cast("string"))).cast("long"))
    if policy == "coerce":
        return bars.withColumn("volume", fails(off > within, "fractional volume").otherwise(F.round(raw).cast("long")))
    if policy == "separate":
        return bars.withColumn("volume", F.floor(raw).cast("long")).withColumn("volume_adj", raw - F.floor(raw))
    if policy == "strict":
        return bars.withColumn("volume", fails(off > 0, "fractional volume").otherwise(raw.cast("long")))
    if policy == "quarantine":
        return bars.withColumn("quarantined", F.coalesce(off > 0, F.lit(False))).withColumn("volume", F.when(off == 0, raw.cast("long")))
    raise ValueError(f"policy {policy!r} is none of {POLICIES}")


def rounding_report(bars: DataFrame) -> DataFrame:
    """A row a symbol of bars(symbol, volume_raw): n rows, n_rounded with a fractional volume, their share, and how many lie near a half, third or quarter,
    as after a split of shares, and elsewhere."""
    part = F.abs(F.col("volume_raw") % 1)
    cut = F.coalesce((part > 0) & (F.abs("volume_raw") < 9.2e18), F.lit(False))
    near = F.when(~cut, None).when(F.abs(part - 0.5) < 0.01, "half").when(F.abs(part - 1 / 3) < 0.01, "third").when(F.abs(part - 0.25) < 0.01, "quarter").otherwise("other")
    held = bars.select("symbol", cut.alias("cut"), near.alias("near"))
    return held.groupBy("symbol").agg(F.count("*").alias("n"), F.count_if("cut").alias("n_rounded"), F.avg(F.col("cut").cast("int")).alias("share"), *(F.count_if(F.col("near") == k).alias(f"n_{k}") for k in ("half", "third", "quarter", "other")))
