"""Exports, range-query JSON, training sets, and small states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import compress_labels
from ..functions.scalars import epoch_timestamp, sample_value
from ..keys import TIME

SAMPLE = "timestamp timestamp_ntz, container_labels string, value double, container_id string"
RANGE_QUERY = "status string, data struct<resultType: string, result: array<struct<metric: map<string,string>, values: array<array<string>>>>>"
FORMATS = ("csv", "parquet")
#: Times with all their microseconds.
CSV = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
SPLITS = ("train", "validation", "test")


def metric_of_file(path: Column, short: bool = False) -> Column:
    """File name less its last two ``_`` parts; ``short`` also drops ``container_``.

    A file inside a folder of such a name, as Spark writes them, has the folder's (after ``key=``, if there is one).
    """
    name = F.regexp_extract(path, r"([^/=]+?)_\d{8}_\d{6}\.csv(?:/[^/]+)?$", 1)
    return F.regexp_replace(name, "^container_", "") if short else name


def read_exports(spark: SparkSession, path: str | list[str], short: bool = False) -> DataFrame:
    """Samples of CSV exports below a path; the metric's name comes from the file's."""
    df = spark.read.schema(SAMPLE).options(**CSV).option("recursiveFileLookup", True).csv(path)
    return df.withColumn("metric_name", metric_of_file(F.input_file_name(), short))


def latest_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """(metric_name, path): the newest export of each metric; names of another form are left out."""
    name = metric_of_file(F.col(path))
    stamp = F.try_to_timestamp(F.regexp_extract(path, r"_(\d{8}_\d{6})\.csv$", 1), F.lit("yyyyMMdd_HHmmss"))
    rows = paths.select(name.alias("metric_name"), F.col(path).alias("path"), stamp.alias("stamp")).filter("metric_name <> '' and stamp is not null")
    return rows.groupBy("metric_name").agg(F.max_by("path", "stamp").alias("path"), F.max("stamp").alias("stamp"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder, as a DataFrame, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def read_range_queries(spark: SparkSession, path: str, metric: str) -> DataFrame:
    """Samples of range-query results in JSON files (one result a file)."""
    raw = spark.read.schema(RANGE_QUERY).option("multiLine", True).json(path)
    return flatten_range_queries(raw.withColumn("metric_name", F.lit(metric)))


def flatten_range_queries(raw: DataFrame, nan_as_null: bool = False) -> DataFrame:
    """One row for each value of each series: time, labels, value, container id, metric."""
    series = raw.select("metric_name", F.explode("data.result").alias("s"))
    values = series.select("metric_name", "s.metric", F.explode("s.values").alias("v"))
    return values.select(
        epoch_timestamp(F.col("v")[0].cast("double")).alias(TIME),
        compress_labels(F.col("metric")).alias("container_labels"),
        sample_value(F.col("v")[1], nan_as_null).alias("value"),
        F.coalesce(F.col("metric")["id"], F.lit("")).alias("container_id"),
        "metric_name",
    )


#: Pieces of a range-query result between closing brackets: a sample, and the beginning of a series.
_PAIR = r'\[\s*([-+0-9.eE]+)\s*,\s*"([^"\\]*)"\s*'
_NEXT = rf"^\s*,\s*{_PAIR}$"
_VALUES = r'"values"\s*:\s*\['
_SAMPLE = rf"(?:^\s*,|{_VALUES})\s*{_PAIR}$"
_BEGINS = r'"metric"\s*:\s*\{'
_LABELS = r'\{[^"{}]*+(?:"(?:[^"\\]++|\\.)*+"[^"{}]*+)*+\}'
_NO_PAIR = rf'{_VALUES}\s*\[(?!\s*[-+0-9.eE]+\s*,\s*")'
_HEADER = rf'"metric"\s*:\s*({_LABELS})\s*,\s*{_VALUES}\s*(?:{_PAIR}(?:\]|$)|\]|$)'


def read_range_files(spark: SparkSession, path: str | list[str], metric: str | None = None, nan_as_null: bool = False) -> DataFrame:
    """``read_range_queries`` for files of any size, one or more results a file.

    Files are read as text that ends at each closing bracket, so Spark cuts them into splits wherever it
    likes, inside a series, too.  A piece is a sample, or belongs to what stands between samples: the
    labels of the next series.  Series are numbered by their beginnings, within a split and after those of
    the file's splits before, and samples meet their labels by that number; only labels are gathered.

    ``metric`` names all samples; without it the label ``__name__`` does.  In a series ``metric`` must come
    before ``values``, and values are pairs of a number and a string, as range queries write them; another
    order raises.  Results of other kinds and series without values have no rows, nor have empty files.
    """
    raw = spark.read.option("lineSep", "]").option("recursiveFileLookup", True).text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"))
    begins = F.col("piece").rlike(_BEGINS).cast("long")
    totals = pieces.groupBy("file", "start").agg(F.sum(begins).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("file").alias("_file"), F.col("start").alias("_start"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    so_far = Window.partitionBy("file", "start").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)

    def numbered(rows: DataFrame) -> DataFrame:
        met = rows.withColumn("_n", F.sum("begins").over(so_far)).join(bases, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
        return met.withColumn("series", F.col("base") + F.col("_n"))

    between = numbered(pieces.filter(~F.col("piece").rlike(_NEXT)).withColumn("begins", begins))
    texts = between.groupBy("file", "series").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "piece"))), lambda p: p["piece"]), "]").alias("text"))
    found = F.when(F.col("text").rlike(_HEADER), F.regexp_extract("text", _HEADER, 1))
    astray = F.regexp_count("text", F.lit(_VALUES)) > F.when(found.isNotNull(), 1).otherwise(0)
    checked = F.when(astray, F.raise_error(F.concat(F.lit("values without their metric in "), F.col("file")))).otherwise(found)
    known = texts.select(F.col("file").alias("_file"), F.col("series").alias("_of"), F.from_json(checked.cast("string"), "map<string,string>").alias("labels")).filter("labels is not null")
    # what a split needs of a piece: its sample, or that a series begins
    t = F.when(F.col("piece").rlike(_NO_PAIR), F.raise_error(F.concat(F.lit("values that are no pairs of a number and a string in "), F.col("file"))).cast("string")).otherwise(F.regexp_extract("piece", _SAMPLE, 1))
    needed = pieces.select("file", "start", "place", begins.alias("begins"), t.alias("t"), F.regexp_extract("piece", _SAMPLE, 2).alias("v")).filter("begins > 0 or t <> ''")
    samples = numbered(needed).filter("t <> ''").select("file", "series", "t", "v")
    met = samples.join(known, (F.col("file") == F.col("_file")) & (F.col("series") == F.col("_of")))
    return met.select(
        epoch_timestamp(F.col("t").cast("double")).alias(TIME),
        compress_labels(F.col("labels")).alias("container_labels"),
        sample_value(F.col("v"), nan_as_null).alias("value"),
        F.coalesce(F.col("labels")["id"], F.lit("")).alias("container_id"),
        (F.lit(metric) if metric is not None else F.col("labels")["__name__"]).alias("metric_name"),
    )


def metric_catalogue(samples: DataFrame, stamp: str) -> DataFrame:
    """Sorted distinct metric names with the time of discovery."""
    return samples.select("metric_name").distinct().orderBy("metric_name").withColumn("discovery_timestamp", F.lit(stamp))


def time_chunks(bounds: DataFrame, hours: int = 1) -> DataFrame:
    """Rows (start, end) cut into chunks of ``hours``; the last one ends at ``end``."""
    start = F.explode(F.sequence(F.col("start"), F.col("end"), F.expr(f"interval {hours} hours")))
    rows = bounds.select(start.alias("chunk_start"), "end").filter("chunk_start < end")
    return rows.select("chunk_start", F.least(F.col("chunk_start") + F.expr(f"interval {hours} hours"), F.col("end")).alias("chunk_end"))


def export_counts(samples: DataFrame) -> DataFrame:
    """By metric: rows and distinct label strings."""
    return samples.groupBy("metric_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("container_labels").alias("n_containers"))


def write_exports(samples: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Write one folder a metric; returns ``export_counts``."""
    _check(fmt)
    samples.write.mode("overwrite").partitionBy("metric_name").options(**CSV).format(fmt).save(path)
    return export_counts(samples)


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")


def write_frame(df: DataFrame, path: str, fmt: str = "csv") -> None:
    _check(fmt)
    df.write.mode("overwrite").options(**CSV).format(fmt).save(path)


def read_frame(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    """Read what ``write_frame`` wrote; CSV columns are strings unless a schema is given."""
    _check(fmt)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.options(**CSV).format(fmt).load(path)


def write_training_set(windows: DataFrame, path: str) -> None:
    """Windows with ``split``, in folders by metric and split."""
    windows.write.mode("overwrite").partitionBy("metric_name", "split").parquet(path)


def read_training_set(spark: SparkSession, path: str, metric: str, split: str) -> tuple[DataFrame, list[int]]:
    """(windows, horizons) of one metric and split; horizons come from the column names."""
    if split not in SPLITS:
        raise ValueError(f"unknown split: {split}")
    df = spark.read.parquet(path).filter((F.col("metric_name") == metric) & (F.col("split") == split))
    return df, sorted(int(c[2:]) for c in df.columns if c.startswith("y_"))


def write_results(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_state(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A scaler (Parquet) or a vocabulary (JSON): small tables, one file."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def read_state(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)
