"""Label strings, container names, selectors and metric names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..keys import require_columns

#: Fixed names: labels that a compressed label string leaves out.
DROPPED_LABELS = ("id", "__name__", "job", "instance")
#: Fixed names: series name of each metric type, and the other names it goes by.
METRICS = {
    "container_cpu_rate": ("cpu", "cpu_usage", "container_cpu_usage_seconds_total"),
    "container_memory_usage": ("memory", "memory_usage", "container_memory_usage_bytes"),
    "container_fs_reads_rate": ("disk_reads", "container_fs_reads_total"),
    "container_fs_writes_rate": ("disk_writes", "container_fs_writes_total"),
    "container_network_receive_rate": ("network_rx", "container_network_receive_bytes_total"),
    "container_network_transmit_rate": ("network_tx", "container_network_transmit_bytes_total"),
}
CPU = "container_cpu_rate"


def compress_labels(labels: Column) -> Column:
    """A label map as ``k=v,k=v``, sorted by key, less ``DROPPED_LABELS``; empty map: ''."""
    kept = F.map_filter(labels, lambda k, _: ~k.isin(*DROPPED_LABELS))
    pairs = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit(""))))
    return F.coalesce(F.array_join(pairs, ","), F.lit(""))


def parse_labels(text: Column) -> Column:
    """``k=v,k=v`` as a map."""
    return F.str_to_map(text, F.lit(","), F.lit("="))


#: Fixed patterns: where a container's name stands in a label string, and what is cut from a pod's.
CONTAINER_LABEL, POD_LABEL, POD_TAIL = "(?i)container=([^,]+)", "(?i)pod=([^,]+)", "-[a-f0-9]+$"


def container_name(labels: Column) -> Column:
    """Value of ``container=`` (any case), else of ``pod=`` less one trailing hex part; else null."""
    found = F.trim(F.regexp_extract(labels, CONTAINER_LABEL, 1))
    pod = F.trim(F.regexp_extract(labels, POD_LABEL, 1))
    return F.when(found != "", found).when(pod != "", F.regexp_replace(pod, POD_TAIL, ""))


def with_container_name(df: DataFrame, labels: str = "container_labels", strict: bool = True) -> DataFrame:
    """Add ``container_name``; rows without one raise, or keep null if not ``strict``."""
    require_columns(df, labels)
    name = container_name(F.col(labels))
    if strict:
        empty = F.col(labels).isNull() | (F.trim(labels) == "")
        said = F.when(empty, "container_labels cannot be empty").otherwise(F.concat(F.lit("Could not extract container name from: "), labels))
        name = F.coalesce(name, F.raise_error(said).cast("string"))
    return df.withColumn("container_name", name)


def rejected_labels(df: DataFrame, labels: str = "container_labels") -> DataFrame:
    """Rows from which no container name can be taken."""
    return df.filter(container_name(F.col(labels)).isNull())


def label_selector(labels: Column, container: str | None = None, namespace: str | None = None, **more: str) -> Column:
    """Rows whose label map fits: id under /kubepods, anchored regexes, equality else."""

    def whole(name: str, pattern: str) -> Column:
        return F.coalesce(labels[name], F.lit("")).rlike(f"^(?:{pattern})$")

    fits = whole("id", "/kubepods.*")
    if container:
        fits &= whole("container", container)
    if namespace:
        fits &= whole("namespace", namespace)
    for name, value in more.items():
        fits &= whole(name, value) if "|" in value or ".*" in value else F.coalesce(labels[name], F.lit("")) == value
    return fits


def parse_container_argument(text: str | None) -> list[str] | str | None:
    """'a, b' gives a list; '' and 'all' give None (everything); one name stays a string."""
    if not text or text.strip().lower() == "all":
        return None
    names = [x.strip() for x in text.split(",") if x.strip()]
    return names if "," in text else names[0]


def select_containers(df: DataFrame, container: str | None = None, containers: list[str] | None = None) -> DataFrame:
    """Rows of the chosen containers.

    A list means membership and beats ``container``, of which '' and 'all'
    choose everything.  One name means equality and, only where no row
    equals it, a case-insensitive regex found anywhere in the name.
    """
    require_columns(df, "container_name")
    if containers:
        chosen = df.filter(F.col("container_name").isin(containers))
        if chosen.isEmpty():
            raise ValueError(f"No data found for containers: {containers}")
        return chosen
    if container in (None, "", "all"):
        return df
    equal = df.filter(F.col("container_name") == container)
    if not equal.isEmpty():
        return equal
    like = df.filter(F.col("container_name").rlike(f"(?i){container}"))
    if like.isEmpty():
        raise ValueError(f"No data found for container: {container}")
    return like


def metric_of(name: str) -> str:
    """Series name of a metric or of one of its other names; unknown names mean CPU."""
    return next((m for m, others in METRICS.items() if name == m or name.lower() in others), CPU)


def known_metrics(names: list[str]) -> list[str]:
    """The known ones of the names; others are skipped."""
    return [n for n in names if n in METRICS or any(n in others for others in METRICS.values())]


def select_metric(df: DataFrame, metric: str, label: str | None = None) -> DataFrame:
    """Rows of one metric (and of one ``label_name``, if there is such a column)."""
    require_columns(df, "metric_name")
    chosen = df.filter(F.col("metric_name") == metric)
    if label is not None and "label_name" in df.columns:
        chosen = chosen.filter(F.col("label_name") == label)
    if chosen.isEmpty():
        raise ValueError(f"No data found for metric: {metric}")
    return chosen


def last_segment(container_id: Column) -> Column:
    return F.element_at(F.split(container_id, "/"), -1)


def short_id(container_id: Column, size: int = 20) -> Column:
    """The last path segment, cut to ``size`` characters and ``...``."""
    segment = last_segment(container_id)
    return F.when(F.length(segment) > size, F.concat(segment.substr(1, size), F.lit("..."))).otherwise(segment)


def series_suffix(container_id: Column) -> Column:
    """The last 12 characters of the last path segment."""
    return F.right(last_segment(container_id), F.lit(12))
