import datetime as dt
import time
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import rates, scale, vocabulary
from pulsegrid.sources import io
from pulsegrid.streaming import live

T0 = dt.datetime(2024, 1, 1)


def test_range_query_files(spark, tmp_path):
    doc = {"status": "success", "data": {"resultType": "matrix", "result": [{"metric": {"id": "/k", "b": "2", "a": "1"}, "values": [[1704067200, "1.5"], [1704067215.5, "NaN"]]}, {"metric": {"pod": "p"}, "values": [[1704067200, "abc"]]}]}}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    got = sorted(map(tuple, io.read_range_queries(spark, str(tmp_path / "r.json"), "m").collect()))
    assert got == [(T0, "a=1,b=2", 1.5, "/k", "m"), (T0, "pod=p", 0.0, "", "m"), (T0 + dt.timedelta(seconds=15.5), "a=1,b=2", 0.0, "/k", "m")]


def test_range_files_in_splits(spark, tmp_path):
    """Splits fall inside series, samples and labels; rows are those of the reader that takes files whole."""
    odd = ["plain", "a]b", "x],[1,\"2\"]", "]]", 'q"]}', "\\]", '"metric":{"a":"b"},"values":[[1,"2"', "é]ü", ""]
    for f in range(3):
        series = [{"metric": {"__name__": "m", "id": f"/{f}", "k": v}, "values": [[1704067200 + 15 * i + f / 4, ["1.5", "NaN", "-2e3", "+Inf"][i % 4]] for i in range(n)]} for n, v in zip((5, 40, 1, 0, 3, 2, 9, 4, 2), odd)]
        doc = {"status": "success", "data": {"resultType": "matrix", "result": series}, "warnings": ["x]", "y"]}
        (tmp_path / f"{f}.json").write_text(json.dumps(doc, indent=f or None, ensure_ascii=f == 1))
    (tmp_path / "vector.json").write_text(json.dumps({"data": {"resultType": "vector", "result": [{"metric": {"a": "b"}, "value": [1, "2"]}]}}))
    (tmp_path / "error.json").write_text('{"status": "error", "error": "no"}')
    (tmp_path / "empty.json").write_text("")
    want = sorted(map(str, io.read_range_queries(spark, str(tmp_path), "m").collect()))
    assert len(want) == 3 * 66
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "1000b", "97b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted(map(str, io.read_range_files(spark, str(tmp_path)).collect())) == want
            assert sorted(map(str, io.read_range_files(spark, str(tmp_path), "m").collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for bad in ('{"data":{"result":[{"values":[[1,"2"]],"metric":{"a":"b"}}]}}', '{"data":{"result":[{"metric":{"a":"b"},"values":[[1,2]]}]}}', '{"data":{"result":[{"metric":{},"values":[["1","2"]]}]}}'):
        (tmp_path / "bad").mkdir(exist_ok=True)
        (tmp_path / "bad" / "r.json").write_text(bad)
        with pytest.raises(Exception, match="values (without their metric|that are no pairs of a number and a string) in"):
            io.read_range_files(spark, str(tmp_path / "bad")).collect()


def test_exports_and_latest_files(spark, tmp_path):
    names = ["container_cpu_rate_20251224_001604.csv", "container_cpu_rate_20251219_062204.csv", "container_network_transmit_rate_20251219_063035.csv", "notes.csv"]
    for n in names:
        (tmp_path / n).write_text("timestamp,container_labels,value,container_id\n2024-01-01T00:00:00.250000,container=a,1.5,/x\n")
    found = {r.metric_name: r.path.rsplit("/", 1)[1] for r in io.latest_files(io.list_files(spark, str(tmp_path))).collect()}
    assert found == {"container_cpu_rate": names[0], "container_network_transmit_rate": names[2]}
    row = io.read_exports(spark, str(tmp_path / names[0]), short=True).first()
    assert (row.metric_name, row.value, row.timestamp) == ("cpu_rate", 1.5, T0 + dt.timedelta(seconds=0.25))


def test_formats_and_states(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    for fmt in io.FORMATS:
        io.write_frame(df, str(tmp_path / fmt), fmt)
        assert io.read_frame(spark, str(tmp_path / fmt), fmt, "x int, y string").collect() == df.collect()
    with pytest.raises(ValueError):
        io.write_frame(df, str(tmp_path / "z"), "orc")
    io.write_results(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    rows = spark.createDataFrame([(1.0,), (3.0,)], "value double")
    scaler = scale.fit_scaler(rows, ["value"])
    io.write_state(scaler, str(tmp_path / "scaler"))
    again = io.read_state(spark, str(tmp_path / "scaler"), "feature string, center double, scale double")
    assert scale.apply_scaler(rows, again, ["value"]).collect() == scale.apply_scaler(rows, scaler, ["value"]).collect()
    names = vocabulary.build_vocabulary(spark.createDataFrame([("b",), ("a",)], "container_name string"))
    io.write_state(names, str(tmp_path / "names"), "json")
    grown = vocabulary.extend_vocabulary(io.read_state(spark, str(tmp_path / "names"), "container_name string, container_id int", "json"), spark.createDataFrame([("c",)], "container_name string"))
    assert {r.container_name: r.container_id for r in grown.collect()} == {"a": 0, "b": 1, "c": 2}


def test_training_sets_refuse_unknown_splits(spark, tmp_path):
    df = spark.createDataFrame([("m", "train", [1.0], [2.0], [3.0])], "metric_name string, split string, x array<double>, y_4 array<double>, y_12 array<double>")
    io.write_training_set(df, str(tmp_path / "t"))
    back, horizons = io.read_training_set(spark, str(tmp_path / "t"), "m", "train")
    assert horizons == [4, 12] and back.count() == 1
    with pytest.raises(ValueError):
        io.read_training_set(spark, str(tmp_path / "t"), "m", "zzz")


def test_chunks_end_at_the_end(spark):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=2, minutes=30))], "start timestamp_ntz, end timestamp_ntz")
    assert [(r.chunk_end - r.chunk_start).seconds for r in io.time_chunks(df).orderBy("chunk_start").collect()] == [3600, 3600, 1800]


def test_late_rows_are_left_out_of_closed_windows(spark, tmp_path):
    schema = "metric_name string, container_name string, timestamp timestamp_ntz, value double"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    batches = [[("m", "a", at(1), 1.0), ("m", "a", at(2), 3.0), ("m", "a", at(300), 5.0)], [("m", "a", at(3), 100.0), ("m", "a", at(600), 7.0)]]
    out = None
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = live.live_resample(live.read_samples(spark, str(tmp_path / "in"), schema), "15 seconds")
        out = live.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = {r.timestamp: r.value for r in out.collect()}
    assert got == {T0: 2.0, at(300): 5.0}
    stats = spark.createDataFrame([("m", "a", 2.0, 1.0)], "metric_name string, container_name string, mean double, std double")
    alerts = live.live_alerts(out, stats).select(F.col("spike"), F.col("dip")).collect()
    assert [tuple(r) for r in alerts] == [(True, False)]


def test_live_counter_rates_equal_batch_rates_over_restarts(spark, tmp_path):
    schema = "event_id long, metric_name string, container_name string, timestamp timestamp_ntz, value double"
    rng = np.random.default_rng(0)
    rows, value, now = [], {"a": 5.0, "b": 0.0, None: 1.0}, 0.0
    for k in range(240):
        now += float(rng.choice([0, 3, 7, 15]))  # samples of one time, too
        name = ("a", "b", None)[k % 3]
        value[name] = float(rng.uniform(0, 3)) if rng.uniform() < 0.1 else value[name] + float(rng.uniform(0, 9))
        rows.append((k, "m", name, T0 + dt.timedelta(seconds=now), value[name]))
    shuffled = [r for i in range(0, 240, 8) for r in rng.permutation(np.array(rows[i : i + 8], dtype=object)).tolist()]  # late, but within a minute
    dropped = (999, "m", "a", T0, 100.0)  # an hour late
    batches = [shuffled[:80], shuffled[80:160], [*shuffled[160:], dropped]]
    out = None
    for batch in batches:  # each a run of its own, from the checkpoint
        spark.createDataFrame([(int(i), m, c, t, float(v)) for i, m, c, t, v in batch], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = live.live_counter_rates(live.read_samples(spark, str(tmp_path / "in"), schema), 60, "3 minutes")
        out = live.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    want = {r.event_id: r.rate for r in rates.counter_rate(spark.createDataFrame(rows, schema), 60).collect()}
    mark = max(r[3] for r in rows) - dt.timedelta(minutes=3)
    closed = {r[0] for r in rows if r[3] < mark}
    got = {r.event_id: r.rate for r in out.collect()}
    assert set(got) == closed and len(closed) > 150 and out.count() == len(closed)
    assert all(got[k] == want[k] if want[k] is None else abs(got[k] - want[k]) < 1e-9 for k in closed)


def test_silent_counters_are_forgotten(spark, tmp_path):
    schema = "metric_name string, container_name string, timestamp timestamp_ntz, value double"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    batches = [[("m", "a", at(0), 10.0), ("m", "b", at(0), 1.0)], [("m", "b", at(9000), 2.0)], [("m", "b", at(9100), 4.0), ("m", "a", at(9100), 30.0)], [("m", "a", at(9130), 33.0), ("m", "b", at(20_000), None), ("m", "b", at(20_001), 5.0)]]
    out = None
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = live.live_counter_rates(live.read_samples(spark, str(tmp_path / "in"), schema), 20_000, "1 second", "1 hour")
        out = live.run_available(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = {(r.container_name, r.timestamp): r.rate for r in out.collect()}
    assert got == {("a", at(0)): None, ("b", at(0)): None, ("b", at(9000)): None, ("a", at(9100)): None, ("b", at(9100)): 2 / 100, ("a", at(9130)): 3 / 30}


def test_closing_samples_takes_time_in_proportion_to_them():
    n, began = 60_000, time.monotonic()
    held = live._Series(None)
    held.add(np.arange(n) * 1_000_000, np.zeros(n, dtype=np.int64), np.arange(n, dtype=float) * 2)
    out = held.close(n * 1_000_000, n * 1_000_000, 10**12)
    assert len(out["_us"]) == n and np.isnan(out["rate"][0]) and np.allclose(out["rate"][1:], 2.0)
    assert time.monotonic() - began < 5
