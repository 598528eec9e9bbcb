import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from trisect.streaming.continuous import CountLog, Monitor, Watch, merged, reference_counts, report, window_counts

EDGES = {"x": [0.0, 1.0, 2.0, 3.0, 4.0]}
START = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, x double"
REFERENCE = [0.5] * 10 + [1.5] * 10 + [2.5] * 10 + [3.5] * 10


def hours(hour, values):
    """Rows spread over one hour."""
    return [(START + dt.timedelta(hours=hour, seconds=60 * i % 3600), v) for i, v in enumerate(values)]


CALM, SHIFTED, BETWEEN = REFERENCE, [0.5] * 5 + [3.5] * 35, [0.5] * 10 + [1.5] * 6 + [2.5] * 6 + [3.5] * 18


def psi_plainly(values):
    """PSI against the reference's four even bins, shares of all values."""
    total = 0.0
    for b in range(4):
        q = sum(b <= v < b + 1 or (b == 3 and v == 4) for v in values if v is not None) / sum(v is not None for v in values)
        q = q or 1e-8
        total += (0.25 - q) * math.log(0.25 / q)
    return total


def watch(**changes):
    return Watch("ts", "1 hour", EDGES, **{"high": 0.5, "low": 0.05, "up": 2, "down": 2, "least_rows": 5, **changes})


def monitor(spark, tmp_path, **changes):
    frame = spark.createDataFrame([(v,) for v in REFERENCE], "x double")
    return Monitor(str(tmp_path / "state"), watch(**changes), reference_counts(frame, EDGES))


def put(spark, folder, name, rows):
    """One more file in the folder that is streamed."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(folder / name))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def states(table):
    return {r.window_start.hour: r.alert for r in table.collect()}


SERIES = [CALM, SHIFTED, CALM, SHIFTED, SHIFTED, BETWEEN, CALM, BETWEEN, CALM, CALM, CALM]
# On after two shifted hours in a row, held between the limits, off after two calm hours; the last hour is still open.
EXPECTED = [False, False, False, False, True, True, True, True, True, False, None]


def test_hysteresis(spark, tmp_path):
    assert psi_plainly(SHIFTED) > 0.5 > psi_plainly(BETWEEN) > 0.05 > psi_plainly(CALM)
    made = monitor(spark, tmp_path)
    rows = spark.createDataFrame([r for h, v in enumerate(SERIES) for r in hours(h, v)], SCHEMA)
    found = report(window_counts(rows, made.watch), made.reference, made.watch)
    assert states(found) == dict(enumerate(EXPECTED))
    for r in found.collect():
        assert r.psi == pytest.approx(psi_plainly(SERIES[r.window_start.hour])) and (r.n, r.n_null) == (40, 0)


def test_stream_in_any_order_equals_batch(spark, tmp_path):
    source = tmp_path / "source"
    made = monitor(spark, tmp_path)
    everything = []
    for i, hour in enumerate([3, 0, 1, 2, 5, 4, 6, 9, 8, 7, 10]):
        put(spark, source, f"f{i}", hours(hour, SERIES[hour]))
        everything += hours(hour, SERIES[hour])
    made.start(stream(spark, source)).awaitTermination()
    batch = report(window_counts(spark.createDataFrame(everything, SCHEMA), made.watch), made.reference, made.watch)
    found = made.report(spark)
    assert sorted(map(str, found.collect())) == sorted(map(str, batch.collect()))
    assert states(found) == dict(enumerate(EXPECTED))


def test_restart_late_rows_and_withdrawn_alerts(spark, tmp_path):
    source = tmp_path / "source"
    made = monitor(spark, tmp_path)
    for h in range(6):
        put(spark, source, f"a{h}", hours(h, SHIFTED if h in (2, 3) else CALM))
    made.start(stream(spark, source)).awaitTermination()
    assert states(made.report(spark)) == {0: False, 1: False, 2: False, 3: True, 4: True, 5: None}
    logged = {(r.window_start.hour, r.alert) for r in made.alerts(spark).collect()}
    assert logged == {(3, True), (4, True)}
    # Hour 2 turns out to hold many calm rows; a new run goes on from the checkpoint and takes the alerts back.
    again = monitor(spark, tmp_path)
    put(spark, source, "late", hours(2, CALM * 20))
    again.start(stream(spark, source)).awaitTermination()
    assert states(again.report(spark)) == {0: False, 1: False, 2: False, 3: False, 4: False, 5: None}
    late = again.alerts(spark).groupBy("window_start").agg(F.max_by("alert", "batch").alias("alert")).collect()
    assert {(r.window_start.hour, r.alert) for r in late} == {(3, False), (4, False)}
    # Nothing new: nothing changes.
    before = sorted(map(str, again.report(spark).collect()))
    again.start(stream(spark, source)).awaitTermination()
    assert sorted(map(str, again.report(spark).collect())) == before


def test_a_batch_run_twice_counts_once(spark, tmp_path):
    made = monitor(spark, tmp_path)
    for batch, hour in enumerate([0, 1, 1, 2]):
        made.process(spark.createDataFrame(hours(hour, SHIFTED), SCHEMA), batch)
    before = sorted(map(str, made.report(spark).collect())), sorted(map(str, made.alerts(spark).collect()))
    made.process(spark.createDataFrame(hours(2, SHIFTED), SCHEMA), 3)
    assert (sorted(map(str, made.report(spark).collect())), sorted(map(str, made.alerts(spark).collect()))) == before
    # A folder that its writer did not finish does not count.
    (tmp_path / "state/counts/batch=3/_SUCCESS").unlink()
    assert {r.window_start.hour for r in made.report(spark).collect()} == {0, 1}


def test_compaction(spark, tmp_path):
    made = monitor(spark, tmp_path)
    for batch in range(5):
        made.process(spark.createDataFrame(hours(batch, SERIES[batch]), SCHEMA), batch)
        if batch in (1, 3):
            made.counts(spark).compact()
    log = made.counts(spark)
    assert [p.rsplit("/", 1)[1] for p in log.paths()] == ["upto=3", "batch=4"]
    assert [p.rsplit("/", 1)[1] for p in log.paths(before=3)] == ["upto=1", "batch=2"]
    whole = spark.createDataFrame([r for h in range(5) for r in hours(h, SERIES[h])], SCHEMA)
    key = lambda t: sorted(map(str, merged(t).collect()))
    assert key(log.read()) == key(window_counts(whole, made.watch))


def test_nulls_ties_and_nothing(spark, tmp_path):
    made = monitor(spark, tmp_path, up=1, down=1, least_rows=3, lateness="30 minutes")
    odd = [None, float("nan"), -1.0, 9.0, 4.0, 4.0]
    rows = [*hours(0, odd), *hours(0, odd), (None, 1.0), (START + dt.timedelta(hours=1, minutes=29), 1.0)]
    table = spark.createDataFrame(rows, SCHEMA)
    first = {r.window_start.hour: r for r in report(window_counts(table, made.watch), made.reference, made.watch).collect()}
    assert (first[0].n, first[0].n_null, first[0].alert) == (8, 4, None) and (first[1].n, first[1].n_null) == (1, 0)
    later = table.unionByName(spark.createDataFrame([(START + dt.timedelta(hours=1, minutes=30), None)], SCHEMA))
    second = {r.window_start.hour: r for r in report(window_counts(later, made.watch), made.reference, made.watch).collect()}
    assert second[0].alert is True and second[1].alert is None and second[1].n_null == 1
    nothing = table.where("false")
    assert report(window_counts(nothing, made.watch), made.reference, made.watch).count() == 0
    assert made.report(spark) is None and made.alerts(spark) is None and CountLog(spark, str(tmp_path / "x")).read() is None
    made.process(nothing, 0)
    assert made.report(spark).count() == 0 and made.alerts(spark).count() == 0


def test_limits_are_checked():
    for bad in ({"low": 0.6}, {"up": 0}, {"down": 0}, {"least_rows": 0}):
        with pytest.raises(ValueError):
            watch(**bad)
