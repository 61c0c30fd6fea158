"""Queries of the operators over the driver tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import labels, scalars
from .functions.scalars import settled
from .keys import SERIES, TIME
from .operators import clean, correlate, evaluate, explore, features, forecast, rates, scale, split, vocabulary, windows
from .plans import pipelines
from .sources import io
from .streaming import live

HOUR = 3600
WINDOW, HORIZONS, STRIDE = 48, (4, 12), 6
OWN_WINDOW, OWN_HORIZONS, OWN_STRIDE = 240, (20, 60, 120), 4
KINDS = {"click": "cpu", "view": "memory", "purchase": "network"}

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def settled_sql(v: str, digits: int) -> str:
    return f"round({v} + {10.0 ** (-digits - 3)!r}::DOUBLE, {digits}) + 0.0"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: one for each event type and user."""
    e = events(spark, sf_dir)
    name = F.concat(F.lit("user-"), "user_id")
    text = F.concat(F.lit("container="), name, F.lit(",k="), F.regexp_extract("props", '"k": *([0-9]+)', 1), F.lit(",namespace=default"))
    return e.select("event_id", F.col("event_type").alias("metric_name"), name.alias("container_name"), F.col("ts").cast("timestamp_ntz").alias(TIME), "value", F.concat(F.lit("/kubepods/"), name).alias("container_id"), text.alias("container_labels"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few long series: users are dealt to four containers."""
    name = F.concat(F.lit("c"), F.regexp_extract("container_name", "([0-9]+)$", 1).cast("long") % 4)
    return samples(spark, sf_dir).withColumn("container_name", name)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_incomplete(clean.regular_grid(dense(spark, sf_dir), HOUR))


def growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series whose number grows with the users: containers of 40 users each."""
    name = F.concat(F.lit("c"), F.floor(F.regexp_extract("container_name", "([0-9]+)$", 1).cast("long") / 40))
    return samples(spark, sf_dir).withColumn("container_name", name)


def growing_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_incomplete(clean.regular_grid(growing(spark, sf_dir), HOUR))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples at full hours, so keys repeat."""
    return samples(spark, sf_dir).withColumn(TIME, F.date_trunc("HOUR", TIME).cast("timestamp_ntz"))


def small_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_windows(grid(spark, sf_dir), WINDOW, HORIZONS, STRIDE)


def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.temporal_split(small_windows(spark, sf_dir), "window_id")


def own_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_windows(growing_grid(spark, sf_dir), OWN_WINDOW, OWN_HORIZONS, OWN_STRIDE)


def naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions: the last value of each window, for every step."""
    return _last_values(small_windows(spark, sf_dir), HORIZONS)


def _last_values(cut: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    flat = {f"pred_{h}": F.array_repeat(F.element_at("x", -1), h) for h in horizons}
    return evaluate.pair_steps(cut.withColumns(flat), horizons)


WITH = """
WITH samples AS (
  SELECT event_id, event_type AS metric_name, 'user-' || user_id AS container_name, ts AS timestamp, value, '/kubepods/user-' || user_id AS container_id,
         'container=user-' || user_id || ',k=' || regexp_extract(props, '"k": *([0-9]+)', 1) || ',namespace=default' AS container_labels FROM events
), dense AS (SELECT event_id, event_type AS metric_name, 'c' || (user_id % 4) AS container_name, ts AS timestamp, value FROM events
), binned AS (SELECT metric_name, container_name, date_trunc('hour', timestamp)::TIMESTAMP AS timestamp, avg(value) AS value FROM dense GROUP BY ALL
), bounds AS (SELECT metric_name, container_name, min(timestamp) AS lo, max(timestamp) AS hi FROM binned GROUP BY ALL
), slots AS (SELECT metric_name, container_name, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM bounds
), holes AS (SELECT s.metric_name, s.container_name, s.timestamp, value FROM slots s LEFT JOIN binned b USING (metric_name, container_name, timestamp)
), ahead AS (SELECT * REPLACE (last_value(value IGNORE NULLS) OVER (PARTITION BY metric_name, container_name ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS value) FROM holes
), filled AS (SELECT * REPLACE (first_value(value IGNORE NULLS) OVER (PARTITION BY metric_name, container_name ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS value) FROM ahead
), grid AS (SELECT * FROM filled WHERE value IS NOT NULL
), hourly AS (SELECT * REPLACE (date_trunc('hour', timestamp)::TIMESTAMP AS timestamp) FROM samples
), deduplicated AS (SELECT metric_name, timestamp, container_id, max(value) AS value FROM hourly GROUP BY ALL
), collapsed AS (SELECT metric_name, timestamp, sum(value) AS value FROM hourly GROUP BY ALL
), numbered AS (SELECT *, row_number() OVER s - 1 AS row_no, count(*) OVER (PARTITION BY metric_name, container_name) AS n_rows FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)
), cut AS (
  SELECT metric_name, container_name, row_no // 6 AS window_id, row_no, n_rows, timestamp AS window_start, lead(timestamp, 47) OVER s AS window_end,
         list(value) OVER (s ROWS BETWEEN CURRENT ROW AND 47 FOLLOWING) AS x,
         list(value) OVER (s ROWS BETWEEN 48 FOLLOWING AND 51 FOLLOWING) AS y_4, list(value) OVER (s ROWS BETWEEN 48 FOLLOWING AND 59 FOLLOWING) AS y_12,
         lead(timestamp, 48) OVER s AS target_start, lead(timestamp, 51) OVER s AS target_end_4, lead(timestamp, 59) OVER s AS target_end_12
  FROM numbered WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)
), cuts AS (SELECT * FROM cut WHERE row_no % 6 = 0 AND row_no + 60 <= n_rows
), parted AS (
  SELECT *, CASE WHEN p < floor(n * 0.7::DOUBLE) THEN 'train' WHEN p < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY metric_name, container_name ORDER BY window_id) - 1 AS p, count(*) OVER (PARTITION BY metric_name, container_name) AS n FROM cuts)
), predictions AS (
  SELECT metric_name, container_name, window_id, 4 AS horizon, i AS step, y_4[i + 1] AS y_true, x[48] AS y_pred FROM cuts, range(0, 4) t(i)
  UNION ALL SELECT metric_name, container_name, window_id, 12, i, y_12[i + 1], x[48] FROM cuts, range(0, 12) t(i)
), errors AS (SELECT *, y_true - y_pred AS e FROM predictions)
"""

_OVER = "(PARTITION BY metric_name, container_name ORDER BY timestamp)"
_TARGETS = ", ".join(f"list(value) OVER (s ROWS BETWEEN {OWN_WINDOW} FOLLOWING AND {OWN_WINDOW + h - 1} FOLLOWING) AS y_{h}, lead(timestamp, {OWN_WINDOW + h - 1}) OVER s AS target_end_{h}" for h in OWN_HORIZONS)
_STEPS = " UNION ALL ".join(f"SELECT metric_name, container_name, window_id, {h} AS horizon, i AS step, y_{h}[i + 1] AS y_true, x[{OWN_WINDOW}] AS y_pred FROM cuts, range(0, {h}) t(i)" for h in OWN_HORIZONS)
#: The same tables of containers of 40 users each, in windows of the operators' own size.
WITH_GROWING = WITH[: WITH.index("), cut AS (")].replace("(user_id % 4)", "(user_id // 40)") + f"""), cut AS (
  SELECT metric_name, container_name, row_no // {OWN_STRIDE} AS window_id, row_no, n_rows, timestamp AS window_start, lead(timestamp, {OWN_WINDOW - 1}) OVER s AS window_end,
         list(value) OVER (s ROWS BETWEEN CURRENT ROW AND {OWN_WINDOW - 1} FOLLOWING) AS x, {_TARGETS}, lead(timestamp, {OWN_WINDOW}) OVER s AS target_start
  FROM numbered WINDOW s AS {_OVER}
), cuts AS (SELECT * FROM cut WHERE row_no % {OWN_STRIDE} = 0 AND row_no + {OWN_WINDOW + max(OWN_HORIZONS)} <= n_rows
""" + WITH[WITH.index("), parted AS (") : WITH.index("), predictions AS (")] + f"), predictions AS ({_STEPS}), errors AS (SELECT *, y_true - y_pred AS e FROM predictions)\n"


def r(*exprs: str, digits: int = 6) -> str:
    """SQL: each 'expression AS name' rounded; + 0.0 turns -0.0 into 0.0."""
    out = []
    for e in exprs:
        value, name = e.rsplit(" AS ", 1) if " AS " in e else (e, e)
        out.append(f"round({value}, {digits}) + 0.0 AS {name}")
    return ", ".join(out)


# Projections, filters, labels -------------------------------------------------------------------


@query(WITH + "SELECT event_id, regexp_extract(container_labels, 'container=([^,]+)', 1) AS container_name FROM samples")
def p2_container_name(spark, sf_dir):
    rows = labels.with_container_name(samples(spark, sf_dir).drop("container_name"))
    return rows.select("event_id", "container_name")


@query("""SELECT event_id, concat_ws(',', 'k=' || regexp_extract(props, '"k": *([0-9]+)', 1), 'namespace=n' || (user_id % 3), 'pod=p-' || user_id) AS container_labels FROM events""")
def p1_compress_labels(spark, sf_dir):
    return _label_maps(spark, sf_dir).select("event_id", labels.compress_labels(F.col("labels")).alias("container_labels"))


def _label_maps(spark, sf_dir):
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1)
    pairs = {"pod": F.concat(F.lit("p-"), "user_id"), "namespace": F.concat(F.lit("n"), F.col("user_id") % 3), "k": k, "id": F.concat(F.lit("/kubepods/u"), "user_id"), "job": F.lit("cadvisor"), "instance": F.lit("node"), "__name__": F.col("event_type")}
    return events(spark, sf_dir).withColumn("labels", F.create_map(*[x for name, v in pairs.items() for x in (F.lit(name), v)]))


@query("SELECT event_id FROM events WHERE regexp_full_match('n' || (user_id % 3), 'n0|n1') AND regexp_full_match('p-' || user_id, 'p-1.*')")
def p3_label_selector(spark, sf_dir):
    return _label_maps(spark, sf_dir).filter(labels.label_selector(F.col("labels"), namespace="n0|n1", pod="p-1.*")).select("event_id")


@query(WITH + "SELECT event_id FROM samples WHERE container_name IN ('user-1', 'user-2', 'user-30')")
def p4_select_containers(spark, sf_dir):
    return labels.select_containers(samples(spark, sf_dir), containers=["user-1", "user-2", "user-30"]).select("event_id")


@query(WITH + "SELECT event_id FROM samples WHERE regexp_matches(container_name, '(?i)USER-1[0-4]$')")
def p4_select_by_pattern(spark, sf_dir):
    return labels.select_containers(samples(spark, sf_dir), "USER-1[0-4]$").select("event_id")


@query(WITH + "SELECT event_id, value FROM samples WHERE metric_name = 'click'")
def p5_select_metric(spark, sf_dir):
    return labels.select_metric(samples(spark, sf_dir), "click").select("event_id", "value")


@query("""WITH b AS (SELECT event_type AS metric_name, min(ts) AS s, max(ts) AS e FROM events GROUP BY 1)
SELECT chunk_start, least(chunk_start + INTERVAL 6 HOUR, e) AS chunk_end FROM (SELECT e, unnest(generate_series(s, e, INTERVAL 6 HOUR)) AS chunk_start FROM b) WHERE chunk_start < e""")
def p6_time_chunks(spark, sf_dir):
    bounds = samples(spark, sf_dir).groupBy("metric_name").agg(F.min(TIME).alias("start"), F.max(TIME).alias("end"))
    return io.time_chunks(bounds, 6)


@query(f"""WITH t AS (SELECT max(value) AS top FROM events WHERE event_type = 'click')
SELECT event_id, {r("CASE event_type WHEN 'click' THEN least(greatest(CASE WHEN top <= 1 THEN value * 100 ELSE value END, 0), 100) WHEN 'view' THEN greatest(value / 1048576, 0) WHEN 'purchase' THEN greatest(value * 8 / 1048576, 0) ELSE value END AS value")} FROM events, t""")
def p7_units(spark, sf_dir):
    return rounded(clean.convert_units(samples(spark, sf_dir), KINDS).select("event_id", "value"))


@query("SELECT event_id, 'user-' || user_id AS name, CASE WHEN length('user-' || user_id) > 6 THEN substr('user-' || user_id, 1, 6) || '...' ELSE 'user-' || user_id END AS short, right('user-' || user_id, 12) AS suffix FROM events")
def p8_short_ids(spark, sf_dir):
    c = F.col("container_id")
    return samples(spark, sf_dir).select("event_id", labels.last_segment(c).alias("name"), labels.short_id(c, 6).alias("short"), labels.series_suffix(c).alias("suffix"))


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM grid")
def p9_drop_incomplete(spark, sf_dir):
    return rounded(grid(spark, sf_dir))


@query(WITH + "SELECT event_id, container_name FROM samples WHERE container_name IN (SELECT container_name FROM samples GROUP BY 1 ORDER BY md5('3:' || container_name), container_name LIMIT 10)")
def p10_sample_containers(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return vocabulary.restrict(rows, vocabulary.sample_containers(rows, 10, seed=3)).select("event_id", "container_name")


@query("SELECT event_id, event_type, user_id FROM events ORDER BY md5('5:' || event_id), event_id LIMIT 200")
def p10_sample_rows(spark, sf_dir):
    return vocabulary.sample_rows(events(spark, sf_dir), 200, "event_id", seed=5).select("event_id", "event_type", "user_id")


@query(WITH + "SELECT event_id, container_name FROM samples WHERE container_name IN (SELECT container_name FROM samples GROUP BY 1 HAVING count(*) >= 70)")
def j2_restrict(spark, sf_dir):
    rows = samples(spark, sf_dir)
    busy = rows.groupBy("container_name").agg(F.count(F.lit(1)).alias("n")).filter("n >= 70").select("container_name")
    return vocabulary.restrict(rows, busy).select("event_id", "container_name")


@query(WITH_GROWING + ", c AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}')" for c in ["hour", "day_of_week", "minute", "hour_sin", "hour_cos", "dow_sin", "dow_cos", *(f"value_lag_{n}" for n in features.LAGS), *(f"value_roll_{f}_{n}" for n in features.ROLLS for f in ("mean", "std", "min", "max"))]) + """) t(feature))
SELECT metric_name, feature, count(*) AS n_rows FROM (SELECT *, row_number() OVER (PARTITION BY metric_name, container_name ORDER BY timestamp) AS n FROM grid), c WHERE n > 24 GROUP BY ALL""")
def p11_feature_columns(spark, sf_dir):
    """The names of the features, with the rows that have all of them."""
    rows = features.add_features(growing_grid(spark, sf_dir))
    names = F.explode(F.array(*[F.lit(c) for c in features.feature_columns(rows)]))
    return rows.select("metric_name", names.alias("feature")).groupBy("metric_name", "feature").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT event_id, (event_id % 241)::BIGINT AS steps, ((event_id % 241) // 4)::INTEGER AS minutes, (((event_id % 241) // 4) * 4)::INTEGER AS whole_steps FROM events")
def f5_steps_and_minutes(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", (F.col("event_id") % 241).alias("steps"))
    rows = rows.withColumn("minutes", scalars.steps_to_minutes(F.col("steps")))
    return rows.withColumn("whole_steps", scalars.minutes_to_steps(F.col("minutes")))


# Sources ----------------------------------------------------------------------------------------


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 ELSE value END AS value FROM events""")
def s3_sample_values(spark, sf_dir):
    k = F.col("event_id") % 5
    text = F.when(k == 0, "NaN").when(k == 1, "abc").when(k == 2, F.lit(None).cast("string")).otherwise(F.col("value").cast("string"))
    return events(spark, sf_dir).select("event_id", scalars.sample_value(text).alias("value"))


@query("SELECT event_id, ts AS timestamp FROM events")
def s4_epoch_timestamps(spark, sf_dir):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return events(spark, sf_dir).select("event_id", scalars.epoch_timestamp(seconds).alias(TIME))


def _range_queries(spark, sf_dir):
    """One range-query result for each event type: a series for each user."""
    rows = events(spark, sf_dir)
    pair = F.array((F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).cast("string"), F.col("value").cast("string"))
    labels_ = F.create_map(F.lit("id"), F.concat(F.lit("/kubepods/u"), "user_id"), F.lit("pod"), F.concat(F.lit("p-"), "user_id"), F.lit("job"), F.lit("cadvisor"))
    series = rows.groupBy("event_type", labels_["id"].alias("i"), labels_["pod"].alias("p")).agg(F.collect_list(pair).alias("values"))
    series = series.withColumn("metric", F.create_map(F.lit("id"), "i", F.lit("pod"), "p", F.lit("job"), F.lit("cadvisor")))
    return series.select(F.col("event_type").alias("metric_name"), F.struct(F.array(F.struct("metric", "values")).alias("result")).alias("data"))


@query("SELECT event_type AS metric_name, ts AS timestamp, 'pod=p-' || user_id AS container_labels, value, '/kubepods/u' || user_id AS container_id FROM events")
def s2_flatten_range_queries(spark, sf_dir):
    return io.flatten_range_queries(_range_queries(spark, sf_dir))


@query("SELECT event_type AS metric_name, ts AS timestamp, 'pod=p-' || user_id AS container_labels, value, '/kubepods/u' || user_id AS container_id FROM events")
def s2_read_range_files(spark, sf_dir):
    """The results as JSON files, read in splits."""
    path = scratch(spark)
    rows = _range_queries(spark, sf_dir).withColumn("name", F.create_map(F.lit("__name__"), "metric_name"))
    named = F.transform("data.result", lambda s: F.struct(F.map_concat("name", s["metric"]).alias("metric"), s["values"].alias("values")))
    text = F.to_json(F.struct(F.struct(named.alias("result")).alias("data")))
    # times are numbers in such files, values strings
    rows.select(F.regexp_replace(text, r'\["([^"]*)",', "[$1,").alias("value")).write.text(path)
    return io.read_range_files(spark, path)


@query("""SELECT event_type AS metric_name, '/x/' || event_type || '_' || strftime(max(date_trunc('second', ts)), '%Y%m%d_%H%M%S') || '.csv' AS path, max(date_trunc('second', ts))::TIMESTAMP AS stamp FROM events GROUP BY 1""")
def s5_latest_files(spark, sf_dir):
    name = F.concat(F.lit("/x/"), "event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".csv"))
    bad = F.when(F.col("event_id") % 7 == 0, F.lit("/x/readme.txt")).otherwise(name)
    paths = events(spark, sf_dir).select(name.alias("path")).union(events(spark, sf_dir).select(bad))
    return io.latest_files(paths).withColumn("stamp", F.col("stamp").cast("timestamp_ntz"))


@query("SELECT DISTINCT event_type AS metric_name, '2024-01-31' AS discovery_timestamp FROM events")
def s6_metric_catalogue(spark, sf_dir):
    return io.metric_catalogue(samples(spark, sf_dir), "2024-01-31")


@query(WITH + "SELECT metric_name, count(*) AS n_rows, count(DISTINCT container_labels) AS n_containers FROM samples GROUP BY 1")
def s7_export_counts(spark, sf_dir):
    return io.export_counts(samples(spark, sf_dir))


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    sc = spark.sparkContext
    root, held = sc.getConf().get("spark.checkpoint.dir", None), sc._jsc.sc().getCheckpointDir()
    if not root and held.isDefined():
        root = held.get()
    if not root and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = root or f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{root}/scratch-{uuid.uuid4().hex}"


@query(WITH + f"SELECT metric_name, container_labels, timestamp, {r('value')}, container_id FROM samples")
def s1_s7_export_round_trip(spark, sf_dir):
    """Write CSV exports by metric and read them back."""
    path = scratch(spark)
    rows = samples(spark, sf_dir).select(TIME, "container_labels", "value", "container_id", "metric_name")
    io.write_exports(rows, path)
    return rounded(io.read_frame(spark, path, schema=f"{io.SAMPLE}, metric_name string"))


@query(WITH + f"SELECT 'container_' || metric_name || '_usage' AS metric_name, container_labels, timestamp, {r('value')}, container_id FROM samples")
def s1_read_exports(spark, sf_dir):
    """CSV exports whose metric is told by the file's name."""
    path = scratch(spark)
    rows = samples(spark, sf_dir).select(TIME, "container_labels", "value", "container_id", F.concat(F.lit("container_"), "metric_name", F.lit("_usage_20240131_001604.csv")).alias("file"))
    # Spark names the files of a folder itself, so the folder bears the export's name
    rows.write.partitionBy("file").options(**io.CSV).csv(path)
    return rounded(io.read_exports(spark, path))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s8_frame_round_trip(spark, sf_dir):
    """Write and read a frame, as Parquet and as CSV with its schema; both must hold the same rows."""
    rows = events(spark, sf_dir)
    paths = {fmt: scratch(spark) for fmt in io.FORMATS}
    for fmt, path in paths.items():
        io.write_frame(rows, path, fmt)
    csv, parquet = (io.read_frame(spark, paths[fmt], fmt, rows.schema) for fmt in io.FORMATS)
    return csv.join(parquet.select("event_id", "ts", "props"), ["event_id", "ts", "props"]).select(*rows.columns)


@query(f"SELECT 'value' AS feature, {r('avg(value) AS center', 'stddev_pop(value) AS scale')} FROM events")
def s13_scaler_round_trip(spark, sf_dir):
    path = scratch(spark)
    io.write_state(scale.fit_scaler(events(spark, sf_dir), ["value"]), path)
    return rounded(io.read_state(spark, path, "feature string, center double, scale double"))


@query(WITH + "SELECT metric_name, container_name, window_id, split, len(x) AS n_x, len(y_4) AS n_4, len(y_12) AS n_12, '4,12' AS horizons FROM parted WHERE metric_name = 'click' AND split = 'train'")
def s9_training_set_round_trip(spark, sf_dir):
    path = scratch(spark)
    io.write_training_set(split_windows(spark, sf_dir), path)
    back, horizons = io.read_training_set(spark, path, "click", "train")
    n = {"n_x": "x", "n_4": "y_4", "n_12": "y_12"}
    return back.select("metric_name", "container_name", "window_id", "split", *[F.size(c).cast("long").alias(k) for k, c in n.items()], F.lit(",".join(map(str, horizons))).alias("horizons"))


@query("SELECT 'user-' || user_id AS container_name, (row_number() OVER (ORDER BY 'user-' || user_id) - 1)::INTEGER AS container_id FROM (SELECT DISTINCT user_id FROM events)")
def s12_vocabulary_round_trip(spark, sf_dir):
    path = scratch(spark)
    io.write_state(vocabulary.build_vocabulary(samples(spark, sf_dir)), path, "json")
    return io.read_state(spark, path, "container_name string, container_id int", "json")


# Joins and aggregates ---------------------------------------------------------------------------


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM binned")
def a1_resample(spark, sf_dir):
    return rounded(clean.resample(dense(spark, sf_dir), HOUR))


@query(WITH + f""", first AS (SELECT metric_name, container_name, date_trunc('day', min(timestamp))::TIMESTAMP AS day FROM dense GROUP BY ALL)
SELECT metric_name, container_name, day + to_seconds(floor(epoch(timestamp - day) / 50000) * 50000) AS timestamp, {r('avg(value) AS value')} FROM dense JOIN first USING (metric_name, container_name) GROUP BY ALL""")
def a1_resample_odd_step(spark, sf_dir):
    """A width that does not divide a day: bins count from the series' first midnight."""
    return rounded(clean.resample(dense(spark, sf_dir), 50_000))


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM holes")
def j3_regular_grid(spark, sf_dir):
    return rounded(clean.fill_grid(clean.resample(dense(spark, sf_dir), HOUR), HOUR))


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM filled")
def w4_limited_fill(spark, sf_dir):
    return rounded(clean.regular_grid(dense(spark, sf_dir), HOUR))


@query(WITH_GROWING + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM filled")
def w4_limited_fill_growing(spark, sf_dir):
    return rounded(clean.regular_grid(growing(spark, sf_dir), HOUR))


@query(WITH + f""", clip AS (SELECT metric_name, container_name, avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY ALL)
SELECT metric_name, container_name, timestamp, {r('CASE WHEN s > 0 THEN least(greatest(value, greatest(0, m - 1.5 * s)), m + 1.5 * s) ELSE value END AS value')} FROM grid JOIN clip USING (metric_name, container_name)""")
def w11_clip_outliers(spark, sf_dir):
    return rounded(clean.clip_outliers(grid(spark, sf_dir), 1.5))


@query("WITH v AS (SELECT u, (row_number() OVER (ORDER BY u) - 1)::INTEGER AS n FROM (SELECT DISTINCT 'user-' || user_id AS u FROM events)) SELECT event_id, u AS container_name, n AS container_no FROM events JOIN v ON u = 'user-' || user_id")
def j1_container_ids(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return vocabulary.add_container_ids(rows, vocabulary.build_vocabulary(rows)).select("event_id", "container_name", "container_no")


@query("SELECT 'user-' || user_id AS container_name, (row_number() OVER (ORDER BY user_id >= 50, 'user-' || user_id) - 1)::INTEGER AS container_id FROM (SELECT DISTINCT user_id FROM events)")
def a11_vocabulary(spark, sf_dir):
    """Built of some containers, then extended by the others."""
    rows = samples(spark, sf_dir)
    early = F.regexp_extract("container_name", "([0-9]+)$", 1).cast("long") < 50
    return vocabulary.extend_vocabulary(vocabulary.build_vocabulary(rows.filter(early)), rows)


@query(WITH + f""", n AS (SELECT metric_name, timestamp, container_id, count(*) AS n FROM hourly GROUP BY ALL), w AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY n DESC, timestamp, container_id) AS k FROM n)
SELECT metric_name, min(n) AS min_count, max(n) AS max_count, {r('avg(n) AS mean_count')}, max(timestamp) FILTER (k = 1) AS worst_timestamp, max(container_id) FILTER (k = 1) AS worst_container_id FROM w GROUP BY 1""")
def a2_duplicate_profile(spark, sf_dir):
    return rounded(explore.duplicate_profile(hourly(spark, sf_dir)))


@query(WITH + """, n AS (SELECT metric_name, timestamp, container_id, count(*) AS n FROM hourly GROUP BY ALL), w AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY n DESC, timestamp, container_id) AS k FROM n)
SELECT event_id, metric_name FROM hourly JOIN w USING (metric_name, timestamp, container_id) WHERE k = 1""")
def a2_worst_duplicates(spark, sf_dir):
    return explore.worst_duplicates(hourly(spark, sf_dir)).select("event_id", "metric_name")


@query(WITH + f"SELECT metric_name, timestamp, container_id, {r('value')} FROM deduplicated")
def a3_deduplicate(spark, sf_dir):
    return rounded(explore.deduplicate(hourly(spark, sf_dir)))


@query(WITH + f"SELECT metric_name, timestamp, {r('avg(value) AS mean', 'min(value) AS min', 'max(value) AS max', *[f'quantile_cont(value, {q / 100}) AS p{q}' for q in (25, 50, 75, 95, 99)])} FROM deduplicated GROUP BY ALL")
def a4_cluster_statistics(spark, sf_dir):
    return rounded(explore.cluster_statistics(explore.deduplicate(hourly(spark, sf_dir))))


@query(WITH + "SELECT metric_name, count(*) AS n_rows, 7 AS n_columns, 'event_id,metric_name,container_name,timestamp,value,container_id,container_labels' AS columns FROM samples GROUP BY 1")
def a5_dataset_summary(spark, sf_dir):
    return explore.dataset_summary(samples(spark, sf_dir))


@query(WITH + f"SELECT metric_name, count(value) AS count, {r('avg(value) AS mean', 'stddev_samp(value) AS std', 'min(value) AS min', 'quantile_cont(value, 0.25) AS p25', 'quantile_cont(value, 0.5) AS p50', 'quantile_cont(value, 0.75) AS p75', 'max(value) AS max')} FROM samples GROUP BY 1")
def a6_describe(spark, sf_dir):
    return rounded(explore.describe(samples(spark, sf_dir)))


@query(WITH + f"SELECT 'value' AS column, count(*) - count(value) AS n_missing, {r('100.0 * (count(*) - count(value)) / count(*) AS percent')} FROM holes HAVING count(*) > count(value)")
def a7_missing_report(spark, sf_dir):
    return rounded(explore.missing_report(clean.fill_grid(clean.resample(dense(spark, sf_dir), HOUR), HOUR)))


@query(WITH + f"SELECT metric_name, timestamp, {r('value')} FROM collapsed")
def a8_collapse(spark, sf_dir):
    return rounded(explore.collapse(hourly(spark, sf_dir)))


BANDS = """, w AS (SELECT *, count(*) OVER f AS n, avg(value) OVER f AS m, stddev_samp(value) OVER f AS s FROM collapsed WINDOW f AS (PARTITION BY metric_name ORDER BY timestamp ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)
), banded AS (SELECT metric_name, timestamp, value, CASE WHEN n = 20 THEN m END AS band_mean, CASE WHEN n = 20 THEN s END AS band_std FROM w
), flagged AS (SELECT *, band_mean + 2 * band_std AS upper, band_mean - 2 * band_std AS lower, coalesce(value > band_mean + 2 * band_std, false) AS spike, coalesce(value < band_mean - 2 * band_std, false) AS dip FROM banded)
"""


@query(WITH + BANDS + f"SELECT metric_name, timestamp, {r('value', 'band_mean', 'band_std', 'upper', 'lower')}, spike, dip, spike OR dip AS anomaly FROM flagged")
def w3_bands(spark, sf_dir):
    return rounded(explore.bands(explore.collapse(hourly(spark, sf_dir))))


@query(WITH + BANDS + f"SELECT metric_name, count(*) AS total, count_if(spike) AS spikes, count_if(dip) AS dips, count_if(spike OR dip) AS anomalies, {r('100.0 * count_if(spike OR dip) / count(*) AS anomaly_rate', 'avg(value) AS mean', 'stddev_samp(value) AS std', 'stddev_samp(value) / nullif(avg(value), 0) AS cv', 'min(value) AS min', 'max(value) AS max')} FROM flagged GROUP BY 1")
def e7_a9_pattern_statistics(spark, sf_dir):
    return rounded(pipelines.analyze_patterns(hourly(spark, sf_dir))[1])


@query(WITH + f"SELECT metric_name, container_name, count(*) AS n_rows, {r('min(value) AS min_value', 'max(value) AS max_value')}, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp FROM grid GROUP BY ALL")
def a10_range_summary(spark, sf_dir):
    return rounded(explore.range_summary(grid(spark, sf_dir)))


# Features and windows ---------------------------------------------------------------------------

CALENDAR = partial(r, "sin(2 * pi() * h / 24) AS hour_sin", "cos(2 * pi() * h / 24) AS hour_cos", "sin(2 * pi() * d / 7) AS dow_sin", "cos(2 * pi() * d / 7) AS dow_cos")


@query(f"SELECT event_id, h::INTEGER AS hour, d::INTEGER AS day_of_week, minute(ts)::INTEGER AS minute, {CALENDAR()} FROM (SELECT *, hour(ts) AS h, isodow(ts) - 1 AS d FROM events)")
def f1_calendar(spark, sf_dir):
    return rounded(features.add_calendar(samples(spark, sf_dir)).select("event_id", "hour", "day_of_week", "minute", "hour_sin", "hour_cos", "dow_sin", "dow_cos"))


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value', *[f'lag(value, {k}) OVER s AS value_lag_{k}' for k in features.LAGS])} FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)")
def w1_lags(spark, sf_dir):
    return rounded(features.add_lags(grid(spark, sf_dir)))


ROLLING = [f"{f}(value) OVER (s ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS value_roll_{name}_{n}" for n in features.ROLLS for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value', *ROLLING, digits=7)} FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)")
def w2_rolling(spark, sf_dir):
    return rounded(features.add_rolling(grid(spark, sf_dir)), 7)  # means of 32 values have ties at 6


@query(WITH + f"""SELECT * FROM (SELECT metric_name, container_name, timestamp, hour(timestamp)::INTEGER AS hour, (isodow(timestamp) - 1)::INTEGER AS day_of_week, minute(timestamp)::INTEGER AS minute,
{CALENDAR(digits=7).replace(' h ', ' hour(timestamp) ').replace(' d ', ' (isodow(timestamp) - 1) ')}, {r('value', *[f'lag(value, {k}) OVER s AS value_lag_{k}' for k in features.LAGS], *ROLLING, digits=7)} FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)) WHERE value_lag_24 IS NOT NULL AND value_roll_std_4 IS NOT NULL""")
def e3_feature_table(spark, sf_dir):
    return rounded(features.add_features(grid(spark, sf_dir)), 7)


_ARRAYS = ", ".join(f"list_transform({c}, lambda v: {settled_sql('v', 6)}) AS {c}" for c in ("x", "y_4", "y_12"))


def _rounded_arrays(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.transform(c, lambda v: settled(v, 6)) for c in columns})


@query(WITH + f"SELECT metric_name, container_name, window_id, window_start, window_end, target_start AS target_start_4, target_start AS target_start_12, target_end_4, target_end_12, {_ARRAYS} FROM cuts")
def w7_w9_windows(spark, sf_dir):
    return _rounded_arrays(small_windows(spark, sf_dir), "x", "y_4", "y_12")


_OWN_ARRAYS = ", ".join(f"list_transform({c}, lambda v: {settled_sql('v', 6)}) AS {c}" for c in ("x", *(f"y_{h}" for h in OWN_HORIZONS)))


@query(WITH_GROWING + f"SELECT metric_name, container_name, window_id, window_start, window_end, {', '.join(f'target_start AS target_start_{h}, target_end_{h}' for h in OWN_HORIZONS)}, {_OWN_ARRAYS} FROM cuts")
def w7_w9_windows_growing(spark, sf_dir):
    return _rounded_arrays(own_windows(spark, sf_dir), "x", *(f"y_{h}" for h in OWN_HORIZONS))


@query(WITH + f"SELECT metric_name, container_name, window_id, window_start, window_end, {_ARRAYS} FROM cuts")
def m9_window_blocks(spark, sf_dir):
    """The same windows, cut from blocks with a halo."""
    cut = windows.window_blocks(grid(spark, sf_dir), WINDOW, HORIZONS, STRIDE, ("value",), block=100)
    return _rounded_arrays(cut.withColumn("x", F.flatten("x")), "x", "y_4", "y_12")


@query(WITH + """SELECT metric_name, container_name, row_no // 5 AS window_id, row_no AS start_row, timestamp AS window_start, e AS window_end
FROM (SELECT *, lead(timestamp, 23) OVER (PARTITION BY metric_name, container_name ORDER BY timestamp) AS e FROM numbered) WHERE row_no % 5 = 0 AND row_no + 36 <= n_rows""")
def w6_window_index(spark, sf_dir):
    out = windows.window_index(grid(spark, sf_dir), 24, (12,), 5)
    return out.withColumn("start_row", F.col("start_row").cast("long"))


@query(WITH + "SELECT metric_name, container_name, window_id FROM cuts WHERE window_end - window_start = INTERVAL 47 HOUR")
def w10_windows_without_gaps(spark, sf_dir):
    return windows.without_gaps(small_windows(spark, sf_dir), WINDOW, HOUR).select("metric_name", "container_name", "window_id")


@query(WITH + "SELECT metric_name, container_name, count(*) AS n_rows FROM samples GROUP BY ALL HAVING count(*) < 15")
def w8_skipped_series(spark, sf_dir):
    return windows.skipped_series(samples(spark, sf_dir), 10, (5,))


@query(WITH + "SELECT metric_name, container_name, window_id, split FROM parted")
def w12_temporal_split(spark, sf_dir):
    return split_windows(spark, sf_dir).select("metric_name", "container_name", "window_id", "split")


@query(WITH_GROWING + "SELECT metric_name, container_name, window_id, split FROM parted")
def w12_temporal_split_growing(spark, sf_dir):
    return split.temporal_split(own_windows(spark, sf_dir), "window_id").select("metric_name", "container_name", "window_id", "split")


@query(WITH + """SELECT metric_name, container_name, window_id, CASE WHEN p < floor(n * 0.7::DOUBLE) THEN 'train' WHEN p < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY metric_name, container_name, window_id) - 1 AS p, count(*) OVER () AS n FROM cuts)""")
def w12_global_split(spark, sf_dir):
    return split.temporal_split(small_windows(spark, sf_dir), "window_id", scope="global").select("metric_name", "container_name", "window_id", "split")


@query(WITH + """SELECT metric_name, container_name, count(*) AS n_total, count_if(split = 'train') AS n_train, count_if(split = 'validation') AS n_validation, count_if(split = 'test') AS n_test,
count_if(split = 'train') AS train_end, count_if(split IN ('train', 'validation')) AS validation_end FROM parted GROUP BY ALL""")
def w13_split_sizes(spark, sf_dir):
    return split.split_sizes(split_windows(spark, sf_dir))


@query(WITH + f"SELECT container_name, count(*) AS n, {r('100.0 * count(*) / sum(count(*)) OVER () AS percent')} FROM parted WHERE split = 'train' GROUP BY 1")
def a12_container_shares(spark, sf_dir):
    return rounded(split.container_shares(split_windows(spark, sf_dir)))


# Scalers ----------------------------------------------------------------------------------------


@query(f"SELECT 'value' AS feature, {r('min(value) AS center', 'max(value) - min(value) AS scale')} FROM events UNION ALL SELECT 'user_id', {r('min(user_id)::DOUBLE AS center', '(max(user_id) - min(user_id))::DOUBLE AS scale')} FROM events")
def a23_minmax(spark, sf_dir):
    return rounded(scale.fit_scaler(events(spark, sf_dir), ["value", "user_id"], "minmax"))


@query(f"SELECT 'value' AS feature, {r('avg(value) AS center', 'stddev_pop(value) AS scale')} FROM events")
def a23_standard(spark, sf_dir):
    return rounded(scale.fit_scaler(events(spark, sf_dir), ["value"], "standard"))


@query(f"SELECT 'value' AS feature, {r('quantile_cont(value, 0.5) AS center', 'quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS scale')} FROM events")
def a23_robust(spark, sf_dir):
    return rounded(scale.fit_scaler(events(spark, sf_dir), ["value"], "robust"))


@query(f"SELECT 'value' AS feature, {r('avg(value) AS center', 'stddev_pop(value) AS scale')} FROM events, range(0, 5) t(i) WHERE i < event_id % 5")
def a23_weighted(spark, sf_dir):
    """Rows that several windows hold count that often, without exploding them."""
    return rounded(scale.fit_scaler(events(spark, sf_dir).withColumn("w", F.col("event_id") % 5), ["value"], "standard", "w"))


@query(f"SELECT event_id, {r('(value - m) / s AS value')} FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)")
def f4_scale(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return rounded(scale.apply_scaler(rows, scale.fit_scaler(rows, ["value"]), ["value"]).select("event_id", "value"))


@query(WITH + f"""SELECT 'y_4' AS feature, {r('avg(v) AS center', 'stddev_pop(v) AS scale')} FROM (SELECT unnest(y_4) AS v FROM parted WHERE split = 'train') UNION ALL
SELECT 'y_12', {r('avg(v) AS center', 'stddev_pop(v) AS scale')} FROM (SELECT unnest(y_12) AS v FROM parted WHERE split = 'train')""")
def e6_target_scalers(spark, sf_dir):
    return rounded(pipelines.scale_training_data(split_windows(spark, sf_dir), HORIZONS)[1])


@query(WITH + f""", s AS (SELECT avg(v) AS m, stddev_pop(v) AS d FROM (SELECT unnest(y_4) AS v FROM parted WHERE split = 'train'))
SELECT metric_name, container_name, window_id, split, list_transform(y_4, lambda v: {settled_sql('(v - m) / d', 6)}) AS y_4 FROM parted, s""")
def e6_scaled_targets(spark, sf_dir):
    out = pipelines.scale_training_data(split_windows(spark, sf_dir), (4,))[0]
    return _rounded_arrays(out, "y_4").select("metric_name", "container_name", "window_id", "split", "y_4")


@query(WITH + f"""SELECT 'y_4' AS feature, {r('avg(v) AS center', 'stddev_pop(v) AS scale')} FROM (SELECT unnest(y_4) AS v FROM parted WHERE split = 'train') UNION ALL
SELECT 'x_0', {r('avg(v) AS center', 'stddev_pop(v) AS scale')} FROM (SELECT unnest(x) AS v FROM parted WHERE split = 'train')""")
def e6_scalers(spark, sf_dir):
    """Scalers of inputs and targets, both of the training part."""
    data = split_windows(spark, sf_dir)
    return rounded(pipelines.scale_training_data(data, (4,))[1].union(pipelines.input_scalers(data)))


@query(WITH + f""", s AS (SELECT avg(v) AS m, stddev_pop(v) AS d FROM (SELECT unnest(x) AS v FROM parted WHERE split = 'train'))
SELECT metric_name, container_name, window_id, split, list_transform(x, lambda v: {settled_sql('(v - m) / d', 6)}) AS x FROM parted, s""")
def e6_scaled_inputs(spark, sf_dir):
    out = pipelines.scale_training_data(split_windows(spark, sf_dir), (4,))[0]
    return _rounded_arrays(out, "x").select("metric_name", "container_name", "window_id", "split", "x")


# Evaluation -------------------------------------------------------------------------------------

SCORES = ("sqrt(avg(e * e)) AS rmse", "avg(abs(e)) AS mae", "coalesce(100 * avg(CASE WHEN abs(y_true) > 1e-10 THEN abs(e / y_true) END), 0) AS mape", "CASE WHEN var_pop(y_true) > 0 THEN 1 - sum(e * e) / (var_pop(y_true) * count(*)) WHEN sum(e * e) = 0 THEN 1 ELSE 0 END AS r2")


@query(WITH + f"SELECT metric_name, container_name, horizon, count(*) AS n, {r(*SCORES)} FROM errors GROUP BY ALL")
def a18_scores(spark, sf_dir):
    return rounded(evaluate.score(naive(spark, sf_dir)))


@query(WITH_GROWING + f"SELECT metric_name, container_name, horizon, count(*) AS n, {r(*SCORES)} FROM errors GROUP BY ALL")
def a18_scores_growing(spark, sf_dir):
    return rounded(evaluate.score(_last_values(own_windows(spark, sf_dir), OWN_HORIZONS)))


@query(WITH + f""", moves AS (SELECT metric_name, container_name, horizon, sign(y_true - lag(y_true) OVER s) AS t, sign(y_pred - lag(y_pred) OVER s) AS p FROM predictions WINDOW s AS (PARTITION BY metric_name, container_name, window_id, horizon ORDER BY step))
SELECT metric_name, container_name, horizon, {r('100 * avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END) AS directional_accuracy')} FROM moves WHERE t IS NOT NULL GROUP BY ALL""")
def a19_directional_accuracy(spark, sf_dir):
    return rounded(evaluate.directional_accuracy(naive(spark, sf_dir)))


@query(WITH + f""", h AS (SELECT metric_name, container_name, horizon, horizon // 4 AS minutes, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM errors GROUP BY ALL)
SELECT metric_name, container_name, list({settled_sql('rmse', 6)} ORDER BY horizon) AS rmse_progression, list({settled_sql('mae', 6)} ORDER BY horizon) AS mae_progression,
{r('(arg_max(rmse, horizon) - arg_min(rmse, horizon)) / (max(minutes) - min(minutes)) AS rmse_per_minute', '(arg_max(mae, horizon) - arg_min(mae, horizon)) / (max(minutes) - min(minutes)) AS mae_per_minute')} FROM h GROUP BY ALL""")
def a20_degradation(spark, sf_dir):
    out = evaluate.degradation(evaluate.horizon_analysis(naive(spark, sf_dir)))
    return rounded(_rounded_arrays(out, "rmse_progression", "mae_progression"))


@query(WITH + f"SELECT metric_name, horizon, step, {r('avg(abs(e)) AS mae')} FROM errors GROUP BY ALL")
def a21_step_errors(spark, sf_dir):
    return rounded(evaluate.step_errors(naive(spark, sf_dir))).withColumn("step", F.col("step").cast("long"))


@query(WITH + f"""SELECT k AS kind, {r('sum(l * w) / sum(w) AS loss')} FROM (
SELECT unnest(['mse', 'mae', 'huber']) AS k, unnest([avg(e * e), avg(abs(e)), avg(CASE WHEN abs(e) <= 1 THEN e * e / 2 ELSE abs(e) - 0.5 END)]) AS l, CASE horizon WHEN 12 THEN 2.0 ELSE 1.0 END AS w FROM errors GROUP BY horizon) GROUP BY 1""")
def a22_losses(spark, sf_dir):
    rows = naive(spark, sf_dir)
    parts = [evaluate.loss(rows, kind, {12: 2.0}).withColumn("kind", F.lit(kind)) for kind in ("mse", "mae", "huber")]
    return rounded(pipelines.union_all(parts)).select("kind", "loss")


@query(WITH + f"SELECT horizon, {r('sum(pow(0.9, step) * m) / sum(pow(0.9, step)) AS loss')} FROM (SELECT horizon, step, avg(e * e) AS m FROM errors GROUP BY ALL) GROUP BY 1")
def a22_decayed_mse(spark, sf_dir):
    return rounded(evaluate.decayed_mse(naive(spark, sf_dir), 0.9))


@query(WITH + f"SELECT metric_name, container_name, window_id, {r('x[48] AS last_state')} FROM cuts")
def m7_last_states(spark, sf_dir):
    return rounded(windows.last_states(small_windows(spark, sf_dir)).select("metric_name", "container_name", "window_id", "last_state"))


# Counters ---------------------------------------------------------------------------------------


def _counters(spark, sf_dir):
    """Running totals of each user that start again every 25 events, at distinct seconds."""
    rows = dense(spark, sf_dir)
    w = Window.partitionBy(*SERIES).orderBy(TIME, "event_id")
    rows = rows.withColumn("_n", F.row_number().over(w) - 1).withColumn("_era", F.floor(F.col("_n") / 25))
    return rows.withColumn("value", F.sum("value").over(Window.partitionBy(*SERIES, "_era").orderBy("_n"))).drop("_n", "_era")


@query(WITH + f""", n AS (SELECT *, row_number() OVER (PARTITION BY metric_name, container_name ORDER BY timestamp, event_id) - 1 AS n FROM dense
), c AS (SELECT * REPLACE (sum(value) OVER (PARTITION BY metric_name, container_name, n // 25 ORDER BY n) AS value) FROM n
), g AS (SELECT *, CASE WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS grown FROM c WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp, event_id)
), t AS (SELECT event_id, timestamp, sum(grown) OVER f - coalesce(first_value(coalesce(grown, 0)) OVER f, 0) AS grew, epoch(timestamp - min(timestamp) OVER f) AS covered FROM g
  WINDOW f AS (PARTITION BY metric_name, container_name ORDER BY timestamp RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))
SELECT event_id, {r('CASE WHEN covered > 0 THEN grew / covered END AS rate')} FROM t""")
def a24_counter_rate(spark, sf_dir):
    return rounded(rates.counter_rate(_counters(spark, sf_dir), 86_400).select("event_id", "rate"))


@query(f"""WITH b AS (SELECT event_type AS metric_name, le, count(*) FILTER (value <= le)::DOUBLE AS count FROM events, (VALUES (5.0::DOUBLE), (20.0), (50.0), (100.0), (200.0), ('inf'::DOUBLE)) l(le) GROUP BY ALL
), w AS (SELECT *, max(count) OVER p AS total, coalesce(lag(le) OVER (p ORDER BY le), 0) AS low, coalesce(lag(count) OVER (p ORDER BY le), 0) AS below FROM b WINDOW p AS (PARTITION BY metric_name)
), h AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY le) AS k FROM w WHERE count >= 0.95 * total AND total > 0)
SELECT metric_name, {r("CASE WHEN le = 'inf' THEN low ELSE coalesce(low + (le - low) * ((0.95 * total - below) / nullif(count - below, 0)), le) END AS quantile")} FROM h WHERE k = 1""")
def a25_bucket_quantile(spark, sf_dir):
    bounds = [5.0, 20.0, 50.0, 100.0, 200.0, float("inf")]
    rows = samples(spark, sf_dir).withColumn("le", F.explode(F.array(*[F.lit(b) for b in bounds])))
    buckets = rows.groupBy("metric_name", "le").agg(F.count_if(F.col("value") <= F.col("le")).cast("double").alias("count"))
    return rounded(rates.bucket_quantile(buckets, 0.95, ("metric_name",)))


_EXPORTS = """WITH s AS (SELECT CASE event_type WHEN 'click' THEN 'container_cpu_rate' WHEN 'view' THEN 'container_memory_usage' WHEN 'purchase' THEN 'container_fs_reads_rate' WHEN 'signup' THEN 'container_network_receive_rate' ELSE 'container_fs_writes_rate' END AS metric_name, user_id, ts, value FROM events
), i AS (SELECT *, CASE WHEN value < lag(value) OVER o THEN value ELSE value - lag(value) OVER o END AS grown FROM s WINDOW o AS (PARTITION BY metric_name, user_id ORDER BY ts, value)
), j AS (SELECT *, sum(coalesce(grown, 0)) OVER (PARTITION BY metric_name, user_id ORDER BY ts, value ROWS UNBOUNDED PRECEDING) AS run FROM i
), t AS (SELECT *, max(run) OVER f - min(run) OVER f AS grew, epoch(ts - min(ts) OVER f) AS covered FROM j
  WINDOW f AS (PARTITION BY metric_name, user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
), x AS (SELECT metric_name, user_id, ts, CASE WHEN metric_name LIKE '%_rate' THEN CASE WHEN covered > 0 THEN grew / covered END ELSE value END AS value FROM t
), exported AS (SELECT * FROM x WHERE value IS NOT NULL)
"""


@query(_EXPORTS.replace("metric_name, user_id ORDER", "metric_name ORDER") + f"SELECT metric_name, count(*) AS n, {r('sum(round(value, 6)) AS total')} FROM exported GROUP BY 1")
def e9_export_metrics(spark, sf_dir):
    """Counters and gauges from range-query results to exported metrics, counted; pods p-<hex> are one container."""
    return rounded(pipelines.export_metrics(_named_range_queries(spark, sf_dir), 86_400)).groupBy("metric_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query(_EXPORTS + """, e AS (SELECT * FROM exported WHERE user_id::VARCHAR LIKE '1%'), b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM e
), c AS (SELECT lo + k * INTERVAL 24 HOUR AS a, least(lo + (k + 1) * INTERVAL 24 HOUR, hi) AS z, hi FROM b, range(0, 400) t(k) WHERE lo + k * INTERVAL 24 HOUR < hi)
SELECT 'catalogue' AS part, metric_name AS name, '2024-01-31' AS said, 0 AS n_rows, 0 AS n_containers FROM e GROUP BY 2
UNION ALL SELECT 'export', metric_name, '', count(*), count(DISTINCT user_id) FROM e GROUP BY 2
UNION ALL SELECT 'chunk', strftime(a, '%Y-%m-%d %H:%M:%S'), strftime(z, '%Y-%m-%d %H:%M:%S'), (SELECT count(*) FROM e WHERE ts >= a AND (ts < z OR z = c.hi)), 0 FROM c""")
def e9_export_run(spark, sf_dir):
    """Selected series, exported in files: the catalogue, the counts, and the rows of each day's chunk."""
    catalogue, counts, chunks = pipelines.export_run(_named_range_queries(spark, sf_dir, True), scratch(spark), "2024-01-31", container="u-1.*", hours=24, seconds=86_400)
    none = F.lit(0).cast("long")

    def row(df, part, name, said, rows=none, containers=none):
        return df.select(F.lit(part).alias("part"), name.alias("name"), said.alias("said"), rows.alias("n_rows"), containers.alias("n_containers"))

    first = row(catalogue, "catalogue", F.col("metric_name"), F.col("discovery_timestamp"))
    second = row(counts, "export", F.col("metric_name"), F.lit(""), F.col("n_rows"), F.col("n_containers"))
    form = "yyyy-MM-dd HH:mm:ss"
    return first.union(second).union(row(chunks, "chunk", F.date_format("chunk_start", form), F.date_format("chunk_end", form), F.col("n_rows")))


def _named_range_queries(spark, sf_dir, containers=False):
    """Range queries of source metrics; on demand with a container label."""
    names = F.create_map(*[F.lit(x) for p in zip(("click", "view", "purchase", "signup", "error"), ("container_cpu_usage_seconds_total", "container_memory_usage_bytes", "container_fs_reads_total", "container_network_receive_bytes_total", "container_fs_writes_total"), strict=True) for x in p])
    raw = _range_queries(spark, sf_dir).withColumn("metric_name", names[F.col("metric_name")])
    if not containers:
        return raw
    named = F.transform("data.result", lambda s: s.withField("metric", F.map_concat(s["metric"], F.create_map(F.lit("container"), F.regexp_replace(s["metric"]["pod"], "^p", "u")))))
    return raw.withColumn("data", F.col("data").withField("result", named))


# Correlation ------------------------------------------------------------------------------------


def _aligned(spark, sf_dir):
    return correlate.align(correlate.named_series(clean.resample(dense(spark, sf_dir), HOUR)))


ALIGN = """, named AS (SELECT metric_name || '/' || container_name AS series, timestamp, value FROM binned
), cells AS (SELECT series, timestamp, value FROM (SELECT DISTINCT timestamp FROM named) CROSS JOIN (SELECT DISTINCT series FROM named) LEFT JOIN named USING (series, timestamp)
), carried AS (SELECT series, timestamp, last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS value FROM cells
), aligned AS (SELECT series, timestamp, first_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM carried
), ranks AS (SELECT series, timestamp, rank() OVER (PARTITION BY series ORDER BY value) + (count(*) OVER (PARTITION BY series, value) - 1) / 2.0 AS value FROM aligned)
"""


def _corr(table: str) -> str:
    return f"SELECT a.series AS series_a, b.series AS series_b, corr(a.value, b.value) AS r FROM {table} a JOIN {table} b USING (timestamp) WHERE a.series < b.series GROUP BY ALL"


@query(WITH + ALIGN + f"SELECT series, timestamp, {r('value')} FROM aligned")
def j4_w5_align(spark, sf_dir):
    return rounded(_aligned(spark, sf_dir).select("series", TIME, "value"))


@query(WITH + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('aligned')})")
def a13_pearson(spark, sf_dir):
    return rounded(correlate.pearson(_aligned(spark, sf_dir)))


@query(WITH_GROWING + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('aligned')})")
def a13_pearson_of_runs(spark, sf_dir):
    """The same coefficients without aligned rows."""
    return rounded(correlate.correlation_of_samples(correlate.named_series(clean.resample(growing(spark, sf_dir), HOUR))))


@query(WITH_GROWING + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('ranks')})")
def a14_spearman_of_runs(spark, sf_dir):
    return rounded(correlate.correlation_of_samples(correlate.named_series(clean.resample(growing(spark, sf_dir), HOUR)), "spearman"))


@query(WITH_GROWING + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('aligned')})")
def a13_pearson_growing(spark, sf_dir):
    """The pairs grow with the square of the series, as the matrix does."""
    return rounded(correlate.pearson(correlate.align(correlate.named_series(clean.resample(growing(spark, sf_dir), HOUR)))))


@query(WITH + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('ranks')})")
def a14_spearman(spark, sf_dir):
    return rounded(correlate.spearman(_aligned(spark, sf_dir)))


def _daily(spark, sf_dir):
    """Few times, so that all pairs of times of all pairs of series can be told in SQL."""
    return correlate.align(correlate.named_series(clean.resample(dense(spark, sf_dir), 86_400).withColumn("value", F.round("value", 0))))


@query("WITH named AS (SELECT event_type || '/c' || (user_id % 4) AS series, date_trunc('day', ts)::TIMESTAMP AS timestamp, round(avg(value), 0) AS value FROM events GROUP BY ALL" + ALIGN[ALIGN.index("\n)") :] + f""", p AS (SELECT a.series AS sa, b.series AS sb, a.timestamp AS t, a.value AS x, b.value AS y FROM aligned a JOIN aligned b USING (timestamp) WHERE a.series < b.series
), q AS (SELECT p.sa, p.sb, sum(sign(p.x - o.x) * sign(p.y - o.y)) AS s, sum(abs(sign(p.x - o.x))) AS nx, sum(abs(sign(p.y - o.y))) AS ny FROM p JOIN p o ON p.sa = o.sa AND p.sb = o.sb AND p.t < o.t GROUP BY ALL)
SELECT sa AS series_a, sb AS series_b, {r('s / sqrt(nullif(nx * ny, 0)) AS r')} FROM q""")
def a15_kendall(spark, sf_dir):
    return rounded(correlate.kendall(_daily(spark, sf_dir)))


@query(WITH + ALIGN + f""", exact AS (SELECT series, timestamp, round(value, 9) AS value FROM aligned), p AS (SELECT a.series AS sa, b.series AS sb, a.timestamp AS t, a.value AS x, b.value AS y FROM exact a JOIN exact b USING (timestamp) WHERE a.series < b.series
), q AS (SELECT p.sa, p.sb, sum(sign(p.x - o.x) * sign(p.y - o.y)) AS s, sum(abs(sign(p.x - o.x))) AS nx, sum(abs(sign(p.y - o.y))) AS ny FROM p JOIN p o ON p.sa = o.sa AND p.sb = o.sb AND p.t < o.t GROUP BY ALL)
SELECT sa AS series_a, sb AS series_b, {r('s / sqrt(nullif(nx * ny, 0)) AS r')} FROM q""")
def a15_kendall_hourly(spark, sf_dir):
    """On the series of a13 and a14; equal means are ties whatever the order of their sums."""
    return rounded(correlate.kendall(_aligned(spark, sf_dir).withColumn("value", F.round("value", 9))))


@query(WITH + ALIGN + f"SELECT series_a, series_b, {r('r')} FROM ({_corr('aligned')}) WHERE abs(r) > 0.08")
def a16_high_correlations(spark, sf_dir):
    return rounded(correlate.high_correlations(correlate.pearson(_aligned(spark, sf_dir)), 0.08))


@query(WITH + ALIGN + f"SELECT {r('avg(r) AS mean', 'quantile_cont(r, 0.5) AS median', 'max(r) AS max', 'min(r) AS min')} FROM ({_corr('aligned')})")
def e8_a17_correlation_summary(spark, sf_dir):
    series = correlate.named_series(clean.resample(dense(spark, sf_dir), HOUR))
    return rounded(pipelines.analyze_correlations(series)[2])


@query(WITH + ALIGN + f"""SELECT series_a, series_b, {r('r')} FROM ({_corr('aligned')}) UNION ALL SELECT series_b, series_a, {r('r')} FROM ({_corr('aligned')}) UNION ALL SELECT DISTINCT series, series, 1.0::DOUBLE FROM aligned""")
def s11_matrix_csv_round_trip(spark, sf_dir):
    """The square matrix written as CSV and read back, as one row for each cell."""
    path = scratch(spark)
    correlate.write_square(correlate.pearson(_aligned(spark, sf_dir)), path)
    return rounded(correlate.unpivoted(io.read_frame(spark, path)))


_SERIES = [f"{kind}/c{k}" for kind in ("click", "error", "purchase", "signup", "view") for k in range(4)]


@query(f"SELECT series_a AS series, {', '.join(f"""max(CASE WHEN series_b = '{name}' THEN r END) AS "{name}\"""" for name in _SERIES)} FROM ({_SQL['s11_matrix_csv_round_trip']}) GROUP BY 1")
def s11_square_matrix(spark, sf_dir):
    return rounded(correlate.square(correlate.pearson(_aligned(spark, sf_dir))))


# Forecasts --------------------------------------------------------------------------------------


@query(WITH + f""", d AS (SELECT *, value - lag(value) OVER s AS d FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)
), l AS (SELECT *, lag(d) OVER (PARTITION BY metric_name, container_name ORDER BY timestamp) AS e FROM d
), f AS (SELECT metric_name, container_name, sum(d * e) / sum(e * e) AS phi, arg_max(value, timestamp) AS v, arg_max(d, timestamp) AS g FROM l GROUP BY ALL)
SELECT metric_name, container_name, k::INTEGER AS step, {r('v + g * list_sum(list_transform(range(1, k + 1), lambda i: pow(phi, i))) AS forecast')} FROM f, range(1, 7) t(k)""")
def m1_arima_110_builtin(spark, sf_dir):
    return rounded(forecast.forecast_ar1_differences(grid(spark, sf_dir), 6))


@query(_SQL["m1_arima_110_builtin"])
def m1_arima_110(spark, sf_dir):
    """The same order, by the general regression in Python."""
    return rounded(forecast.forecast_series(grid(spark, sf_dir), 6, (1, 1, 0)))


@query(_SQL["m1_arima_110_builtin"].replace(WITH, WITH_GROWING))
def m1_arima_110_growing(spark, sf_dir):
    return rounded(forecast.forecast_series(growing_grid(spark, sf_dir), 6, (1, 1, 0)))


@query()
def m1_arima_111(spark, sf_dir):
    return rounded(forecast.forecast_series(growing_grid(spark, sf_dir), 6))


@query()
def m2_seasonal_arima(spark, sf_dir):
    return rounded(forecast.forecast_series(growing_grid(spark, sf_dir), 6, (1, 0, 0), (1, 1, 0, 24)))


@query()
def m3_order_search(spark, sf_dir):
    return rounded(forecast.search_orders(growing_grid(spark, sf_dir)))


_K = "metric_name, container_name"


@query(WITH_GROWING + f""", c AS (SELECT {_K}, value - avg(value) OVER k AS v, row_number() OVER (PARTITION BY {_K} ORDER BY timestamp) AS i, count(*) OVER k AS rows FROM grid WINDOW k AS (PARTITION BY {_K})
), m AS (SELECT *, CASE WHEN rows <= 130 THEN greatest(1, least(32, rows // 4)) ELSE 32 END + 2 AS first, v - lag(v) OVER s AS w1, v - 2 * lag(v) OVER s + lag(v, 2) OVER s AS w2 FROM c WINDOW s AS (PARTITION BY {_K} ORDER BY i)
), w AS ({" UNION ALL ".join(f"SELECT {_K}, i, rows - first AS n, first, {d} AS d, {w} AS w FROM m" for d, w in enumerate(("v", "w1", "w2")))}
), u AS (SELECT *, lag(w) OVER (PARTITION BY {_K}, d ORDER BY i) AS u FROM w
), sums AS (SELECT {_K}, d, n, sum(w * w) AS ww, sum(w * u) AS wu, sum(u * u) AS uu FROM u WHERE i > first GROUP BY ALL
), tried AS ({" UNION ALL ".join(f"SELECT {_K}, {p} AS p, d, n * ln(({e}) / n) + 2 * ({p} + 1 + (d = 0)::INTEGER) AS aic FROM sums" for p, e in enumerate(("ww", "ww - wu * wu / uu")))})
SELECT {_K}, p::INTEGER AS p, d::INTEGER AS d, 0::INTEGER AS q, {r('aic AS aic')} FROM tried QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY tried.aic, p, d) = 1""")
def m3_order_search_closed(spark, sf_dir):
    """The search among orders whose least errors have a closed form."""
    return rounded(forecast.search_orders(growing_grid(spark, sf_dir), [(p, d, 0) for p in (0, 1) for d in (0, 1, 2)]))


@query()
def m4_seasonal_trend(spark, sf_dir):
    return rounded(forecast.forecast_seasonal_trend(growing_grid(spark, sf_dir), 6, HOUR))


@query(WITH_GROWING + f""", n AS (SELECT {_K}, timestamp, value, row_number() OVER (PARTITION BY {_K} ORDER BY timestamp) - 1 AS t FROM grid
), f AS (SELECT {_K}, count(*) AS n, max(timestamp) AS last, regr_slope(value, t) AS b, regr_intercept(value, t) AS a, sqrt(regr_syy(value, t) * greatest(1 - regr_r2(value, t), 0) / count(*)) AS d FROM n GROUP BY ALL
), s AS (SELECT *, a + b * (n - 1 + k) AS forecast FROM f, range(1, 7) h(k))
SELECT {_K}, last + to_hours(k) AS timestamp, {r('s.forecast AS forecast', 's.forecast - 1.96 * d AS lower', 's.forecast + 1.96 * d AS upper')} FROM s""")
def m4_trend(spark, sf_dir):
    """The additive model without bends and waves: a line."""
    return rounded(forecast.forecast_seasonal_trend(growing_grid(spark, sf_dir), 6, HOUR, daily=0, weekly=0, changepoints=0))


#: Order (1, 1, 0) on each test window, in closed form.  Moves of a forecast that has settled are
#: smaller than the errors of either engine, so their signs are left out here and tested in a19.
_ROLLING = f""", tests AS (SELECT *, list_transform(range(2, {OWN_WINDOW} + 1), lambda i: x[i] - x[i - 1]) AS d FROM parted WHERE split = 'test'
), fits AS (SELECT *, coalesce(list_dot_product(d[2:], d[:-2]) / nullif(list_dot_product(d[:-2], d[:-2]), 0), 0) AS phi FROM tests
), steps AS ({" UNION ALL ".join(f"SELECT metric_name, container_name, window_id, {h} AS horizon, i AS step, y_{h}[i + 1] AS y_true, x[{OWN_WINDOW}] + d[-1] * list_sum(list_transform(range(1, i + 2), lambda k: pow(phi, k))) AS y_pred FROM fits, range(0, {h}) t(i)" for h in OWN_HORIZONS)}
), moves AS (SELECT *, y_true - y_pred AS e FROM steps)
SELECT metric_name, container_name, horizon, count(*) AS n, {r(*SCORES)}, (horizon // 4)::INTEGER AS minutes FROM moves GROUP BY ALL"""


@query(WITH_GROWING + _ROLLING)
def e10_m5_rolling_origin(spark, sf_dir):
    """Scores by horizon of a refit on each test window."""
    data = split.temporal_split(own_windows(spark, sf_dir), "window_id")
    return rounded(pipelines.evaluate_forecasts(data, OWN_HORIZONS, (1, 1, 0))[0].drop("directional_accuracy"))


#: The last day again, for each test window; forecasts are scaled by the training part and back, targets are scored as they are.
_SEASONAL = f""", xs AS (SELECT {settled_sql('avg(v)', 9)} AS mx, {settled_sql('stddev_pop(v)', 9)} AS sx FROM (SELECT unnest(x) AS v FROM parted WHERE split = 'train')
), ys AS ({" UNION ALL ".join(f"SELECT {h} AS horizon, {settled_sql('avg(v)', 9)} AS my, {settled_sql('stddev_pop(v)', 9)} AS sy FROM (SELECT unnest(y_{h}) AS v FROM parted WHERE split = 'train')" for h in OWN_HORIZONS)}
), steps AS ({" UNION ALL ".join(f"SELECT metric_name, container_name, window_id, {h} AS horizon, i AS step, y_{h}[i + 1] AS y_true, x[{OWN_WINDOW - 23} + i % 24] AS v FROM parted, range(0, {h}) t(i) WHERE split = 'test'" for h in OWN_HORIZONS)}
), moves AS (
  SELECT *, y_true - ((v - mx) / sx * sy + my) AS e, sign(y_true - lag(y_true) OVER s) AS t, sign(v - lag(v) OVER s) AS p
  FROM steps JOIN ys USING (horizon), xs WINDOW s AS (PARTITION BY metric_name, container_name, window_id, horizon ORDER BY step)
)
SELECT metric_name, container_name, horizon, count(*) AS n, {r(*SCORES)}, (horizon // 4)::INTEGER AS minutes, {r('100 * avg(CASE WHEN t = p THEN 1.0 WHEN t IS NOT NULL THEN 0.0 END) AS directional_accuracy')} FROM moves GROUP BY ALL"""


@query(WITH_GROWING.replace("), grid AS (SELECT * FROM filled", f"), grid AS (SELECT * REPLACE ({settled_sql('value', 9)} AS value) FROM filled") + _SEASONAL)
def e10_scaled_directions(spark, sf_dir):
    """Scores and directions of a seasonal model on scaled windows, its forecasts scaled back once.

    Equal means are equal whatever the order of their sums, so that directions are not left to chance, and so are
    the scalers' constants, since percentages of targets near 0 magnify what they differ by.
    """
    rows = growing_grid(spark, sf_dir).withColumn("value", settled(F.col("value"), 9))
    cut = windows.sliding_windows(rows, OWN_WINDOW, OWN_HORIZONS, OWN_STRIDE)
    data, scalers = pipelines.scale_training_data(split.temporal_split(cut, "window_id"), OWN_HORIZONS, keep=True, digits=9)
    return rounded(pipelines.evaluate_forecasts(data, OWN_HORIZONS, (0, 0, 0), scalers, seasonal=(0, 1, 0, 24))[0])


@query(WITH_GROWING + _ROLLING)
def s10_results_round_trip(spark, sf_dir):
    """The same scores as written to JSON and read back."""
    path = scratch(spark)
    data = split.temporal_split(own_windows(spark, sf_dir), "window_id")
    scores = pipelines.evaluate_forecasts(data, OWN_HORIZONS, (1, 1, 0), path=path)[0]
    return rounded(io.read_results(spark, path, ", ".join(f"{c} {t}" for c, t in scores.dtypes)).drop("directional_accuracy"))


@query()
def m6_batch_score(spark, sf_dir):
    rows = growing_grid(spark, sf_dir)
    q = rows.groupBy("metric_name").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("scale")).withColumnRenamed("metric_name", "feature")
    models = {"click": forecast.arima, "view": partial(forecast.arima, order=(1, 1, 0)), "purchase": _mean_forecast}
    return rounded(forecast.batch_score(rows, models, q, 6))


def _mean_forecast(values: np.ndarray, steps: int) -> np.ndarray:
    return np.full(steps, values.mean())


@query(f"SELECT * FROM ({_SQL['m1_arima_110_growing']}) WHERE metric_name IN ('click', 'view') UNION ALL SELECT * FROM ({WITH_GROWING} SELECT metric_name, container_name, k::INTEGER AS step, {r('avg(value) AS forecast')} FROM grid, range(1, 7) t(k) WHERE metric_name = 'purchase' GROUP BY ALL)")
def m6_batch_score_closed(spark, sf_dir):
    """Models of closed form: scaling and scaling back leave their forecasts as they are."""
    rows = growing_grid(spark, sf_dir)
    q = rows.groupBy("metric_name").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("scale")).withColumnRenamed("metric_name", "feature")
    by_difference = partial(forecast.arima, order=(1, 1, 0))
    return rounded(forecast.batch_score(rows, {"click": by_difference, "view": by_difference, "purchase": _mean_forecast}, q, 6))


# Streams ----------------------------------------------------------------------------------------


def _stream(spark, sf_dir):
    source = live.read_samples(spark, sf_dir, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", "events.parquet")
    return source.select(F.col("event_type").alias("metric_name"), F.concat(F.lit("c"), F.col("user_id") % 4).alias("container_name"), F.col("ts").alias(TIME), "value")


def _closed(sql_window: str) -> str:
    return f"WHERE {sql_window} <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM events)"


@query(f"SELECT metric_name, container_name, t AS timestamp, {r('avg(value) AS value')} FROM (SELECT event_type AS metric_name, 'c' || (user_id % 4) AS container_name, date_trunc('hour', ts)::TIMESTAMP AS t, value FROM events) {_closed('t + INTERVAL 1 HOUR')} GROUP BY ALL")
def r1_live_resample(spark, sf_dir):
    out = live.run_available(live.live_resample(_stream(spark, sf_dir), "1 hour"), scratch(spark), scratch(spark))
    return rounded(out)


@query(f"""SELECT metric_name, container_name, w AS timestamp, w + INTERVAL 2 HOUR AS window_end, {r('avg(value) AS mean', 'max(value) AS max', '(max(value) - min(value)) / nullif(epoch(max(ts) - min(ts)), 0) AS rate')}
FROM (SELECT event_type AS metric_name, 'c' || (user_id % 4) AS container_name, ts, value, unnest([date_trunc('hour', ts)::TIMESTAMP, date_trunc('hour', ts)::TIMESTAMP - INTERVAL 1 HOUR]) AS w FROM events) {_closed('w + INTERVAL 2 HOUR')} GROUP BY ALL""")
def r2_live_rates(spark, sf_dir):
    out = live.run_available(live.live_rates(_stream(spark, sf_dir), "2 hours", "1 hour"), scratch(spark), scratch(spark))
    return rounded(out)


@query(WITH + f""", g AS (SELECT *, CASE WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS grown FROM dense WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp, event_id)
), t AS (SELECT event_id, timestamp, sum(grown) OVER f - coalesce(first_value(coalesce(grown, 0)) OVER f, 0) AS grew, epoch(timestamp - min(timestamp) OVER f) AS covered FROM g
  WINDOW f AS (PARTITION BY metric_name, container_name ORDER BY timestamp RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW))
SELECT event_id, {r('CASE WHEN covered > 0 THEN grew / covered END AS rate')} FROM t WHERE timestamp < (SELECT max(ts) - INTERVAL 1 MINUTE FROM events)""")
def r2_live_counter_rates(spark, sf_dir):
    """The rate of every closed sample, from state in the stream; every fall is a reset."""
    source = live.read_samples(spark, sf_dir, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", "events.parquet")
    stream = source.select("event_id", F.col("event_type").alias("metric_name"), F.concat(F.lit("c"), F.col("user_id") % 4).alias("container_name"), F.col("ts").alias(TIME), "value")
    return rounded(live.run_available(live.live_counter_rates(stream, 6 * HOUR), scratch(spark), scratch(spark)).select("event_id", "rate"))


@query(WITH + f""", s AS (SELECT metric_name, container_name, avg(value) AS m, stddev_samp(value) AS d FROM binned GROUP BY ALL)
SELECT metric_name, container_name, timestamp, {r('value')}, value > m + 2 * d AS spike, value < m - 2 * d AS dip FROM binned JOIN s USING (metric_name, container_name)
{_closed('timestamp + INTERVAL 1 HOUR')} AND (value > m + 2 * d OR value < m - 2 * d)""")
def r3_live_alerts(spark, sf_dir):
    stats = clean.resample(dense(spark, sf_dir), HOUR).groupBy(*SERIES).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    alerts = live.live_alerts(live.live_resample(_stream(spark, sf_dir), "1 hour"), stats)
    return rounded(live.run_available(alerts, scratch(spark), scratch(spark)))


# Pipelines --------------------------------------------------------------------------------------


@query(WITH + f""", clip AS (SELECT metric_name, container_name, avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY ALL)
SELECT metric_name, container_name, timestamp, {r('CASE WHEN s > 0 THEN least(greatest(value, greatest(0, m - 3 * s)), m + 3 * s) ELSE value END AS value')} FROM grid JOIN clip USING (metric_name, container_name)""")
def e1_prepare_metric_data(spark, sf_dir):
    return rounded(pipelines.prepare_metric_data(dense(spark, sf_dir), step=HOUR))


@query(WITH + f"SELECT metric_name, container_name, timestamp, {r('value')} FROM filled WHERE metric_name = 'view'")
def e2_prepare_container_metrics(spark, sf_dir):
    return rounded(pipelines.prepare_container_metrics(dense(spark, sf_dir), "view", step=HOUR))


_FEATURES = ", ".join(["extract(hour FROM timestamp) AS h", "(isodow(timestamp) - 1) AS d", *(f"lag(value, {n}) OVER s AS lag_{n}" for n in features.LAGS), *(f"{f}(value) OVER (s ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {f}_{n}" for n in features.ROLLS for f in ("avg", "stddev_samp", "min", "max"))])
_FEATURE_SUM = " + ".join(["h", "d", "extract(minute FROM timestamp)", "sin(2 * pi() * h / 24)", "cos(2 * pi() * h / 24)", "sin(2 * pi() * d / 7)", "cos(2 * pi() * d / 7)", *(f"lag_{n}" for n in features.LAGS), *(f"{f}_{n}" for n in features.ROLLS for f in ("avg", "stddev_samp", "min", "max"))])
#: Windows over rows that have all features, and the sum of all features in a window.
_FEATURE_WINDOWS = f""", f AS (SELECT * FROM (SELECT *, {_FEATURES} FROM grid WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)) WHERE lag_24 IS NOT NULL
), g AS (SELECT metric_name, container_name, timestamp, value, {_FEATURE_SUM} AS v, row_number() OVER s - 1 AS k, count(*) OVER (PARTITION BY metric_name, container_name) AS m FROM f WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp)
), w AS (SELECT *, sum(v) OVER (s ROWS BETWEEN CURRENT ROW AND {OWN_WINDOW - 1} FOLLOWING) AS total, lead(timestamp, {OWN_WINDOW - 1}) OVER s AS window_end,
  avg(value) OVER (s ROWS BETWEEN {OWN_WINDOW} FOLLOWING AND {OWN_WINDOW + 59} FOLLOWING) AS y FROM g WINDOW s AS (PARTITION BY metric_name, container_name ORDER BY timestamp))
"""


@query(WITH_GROWING + _FEATURE_WINDOWS + f"SELECT metric_name, container_name, k // 4 AS window_id, timestamp AS window_start, {r('total', digits=3)}, {r('y AS y_mean')} FROM w WHERE k % 4 = 0 AND k + {OWN_WINDOW + 60} <= m")
def e3_features_and_windows(spark, sf_dir):
    """Windows over all features with one horizon; the arrays' sums and the targets' means."""
    out = pipelines.features_and_windows(growing_grid(spark, sf_dir), OWN_WINDOW, (60,), OWN_STRIDE)
    total = F.aggregate("x", F.lit(0.0), lambda acc, row: acc + F.aggregate(row, F.lit(0.0), lambda a, v: a + v))
    mean = F.aggregate("y_60", F.lit(0.0), lambda a, v: a + v) / 60
    return out.select(*SERIES, "window_id", "window_start", F.round(total, 3).alias("total"), F.round(mean, 6).alias("y_mean"))


@query(WITH_GROWING + _FEATURE_WINDOWS + f"SELECT metric_name, container_name, k // {OWN_STRIDE} AS window_id, timestamp AS window_start, window_end, {OWN_WINDOW} AS n_rows, 27 AS n_features, {r('total', digits=3)} FROM w WHERE k % {OWN_STRIDE} = 0 AND k + {OWN_WINDOW + max(OWN_HORIZONS)} <= m")
def e4_multi_horizon_windows(spark, sf_dir):
    """All features in windows with three horizons; the arrays' sizes and sums."""
    out = pipelines.multi_horizon_windows(growing_grid(spark, sf_dir), OWN_WINDOW, OWN_HORIZONS, OWN_STRIDE)
    total = F.aggregate("x", F.lit(0.0), lambda acc, row: acc + F.aggregate(row, F.lit(0.0), lambda a, v: a + v))
    return out.select(*SERIES, "window_id", "window_start", "window_end", F.size("x").alias("n_rows"), F.size(F.col("x")[0]).alias("n_features"), F.round(total, 3).alias("total"))


@query(WITH_GROWING + _FEATURE_WINDOWS + f""", z AS (SELECT metric_name, container_name, k // {OWN_STRIDE} AS window_id, timestamp AS window_start, window_end FROM w WHERE metric_name = 'view' AND k % {OWN_STRIDE} = 0 AND k + {OWN_WINDOW + max(OWN_HORIZONS)} <= m
), q AS (SELECT *, row_number() OVER (PARTITION BY container_name ORDER BY window_id) - 1 AS p, count(*) OVER (PARTITION BY container_name) AS n FROM z
), ids AS (SELECT container_name, (row_number() OVER (ORDER BY container_name) - 1)::INTEGER AS container_no FROM (SELECT DISTINCT container_name FROM grid WHERE metric_name = 'view'))
SELECT metric_name, container_name, container_no, window_id, CASE WHEN p < floor(n * 0.7::DOUBLE) THEN 'train' WHEN p < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split, window_start, window_end FROM q JOIN ids USING (container_name)""")
def e5_prepare_training_data(spark, sf_dir):
    data, _ = pipelines.prepare_training_data(growing(spark, sf_dir), "view", step=HOUR, window=OWN_WINDOW, horizons=OWN_HORIZONS, stride=OWN_STRIDE)
    return data.select(*SERIES, "container_no", "window_id", "split", "window_start", "window_end")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
