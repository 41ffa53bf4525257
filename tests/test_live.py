"""The fleet view of a stream, sliding rates of a stream, and latency sketches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from railweave.operators import metrics, sketches
from railweave.schemas import METRIC_SCHEMA, POSITION_SCHEMA
from railweave.streaming import live

NOON = datetime(2024, 5, 1, 12)
AGE = timedelta(hours=2)


def position(number, vehicle, minutes, **more):
    row = dict.fromkeys(POSITION_SCHEMA.names)
    row.update(id=number, event_id=f"e{number}", vehicle_id=vehicle, source="s", route_id="1",
               ingested_at=NOON + timedelta(days=1), vehicle_timestamp=NOON + timedelta(minutes=minutes, microseconds=number))
    row.update(more)
    return tuple(row[n] for n in POSITION_SCHEMA.names)


class Feed:
    """A folder of files read as a stream; ``run`` works off what is there and returns the view."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, str(tmp_path / "rows")
        self.root, self.checkpoint = str(tmp_path / "fleet"), str(tmp_path / "checkpoint")

    def add(self, *rows):
        self.spark.createDataFrame(rows, POSITION_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def run(self):
        stream = self.spark.readStream.schema(POSITION_SCHEMA).parquet(self.path)
        live.stream_fleet(stream, self.root, self.checkpoint, AGE, available_now=True).awaitTermination()
        fleet = live.read_fleet(self.spark, self.root, POSITION_SCHEMA, AGE)
        return {r.vehicle_key: (r.id, r.vehicle_timestamp) for r in fleet.collect()}


def test_fleet_takes_late_and_repeated_events_and_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert live.read_fleet(spark, feed.root, POSITION_SCHEMA, AGE) is None
    feed.add(position(1, "a", 0), position(2, "a", 10), position(3, "b", 5), position(4, "", 5, entity_id="e"), position(5, None, 7))
    assert {k: v[0] for k, v in feed.run().items()} == {"a": 2, "b": 3, "e": 4, "5": 5}
    # A repeat, one that is late but newer than nothing held, and one at the same instant with a higher id.
    same = NOON + timedelta(minutes=10, microseconds=2)
    feed.add(position(2, "a", 10), position(6, "a", 8), position(7, "b", 60), position(8, "a", 0, vehicle_timestamp=same))
    again = feed.run()
    assert {k: v[0] for k, v in again.items()} == {"a": 8, "b": 7, "e": 4, "5": 5}
    assert again["a"][1] == same
    # Nothing new: the view stays.
    assert feed.run() == again
    # Two hours on, only vehicles seen since stay; an event older than that does not bring its vehicle back.
    feed.add(position(9, "c", 185))
    assert {k: v[0] for k, v in feed.run().items()} == {"c": 9}
    feed.add(position(10, "a", 20), position(11, "d", 190))
    assert {k: v[0] for k, v in feed.run().items()} == {"c": 9, "d": 11}
    # A vehicle that had left returns.
    feed.add(position(12, "b", 191))
    assert {k: v[0] for k, v in feed.run().items()} == {"c": 9, "d": 11, "b": 12}


def test_fleet_equals_the_batch_view(spark, tmp_path):
    draw = random.Random(5)
    feed = Feed(spark, tmp_path)
    rows = [position(i, f"v{draw.randrange(12)}", draw.randrange(600)) for i in range(1, 200)]
    for part in range(3):
        feed.add(*rows[part::3])
        seen = [r for p in range(part + 1) for r in rows[p::3]]
        at, vehicle = POSITION_SCHEMA.names.index("vehicle_timestamp"), POSITION_SCHEMA.names.index("vehicle_id")
        newest = max(r[at] for r in seen)
        expected = {}
        for r in sorted(seen, key=lambda r: (r[at], r[0])):
            if r[at] >= newest - AGE:
                expected[r[vehicle]] = r[0]
        assert {k: v[0] for k, v in feed.run().items()} == expected


def test_a_batch_that_runs_again_writes_the_same_view(spark, tmp_path):
    writer = live.FleetWriter(str(tmp_path))
    change = lambda *rows: spark.createDataFrame(rows, live._CHANGE)
    writer(change(("a", 1, 1, "{}", False), ("b", 2, 2, "{}", False)), 0)
    for _ in range(2):
        writer(change(("a", 1, 1, "{}", True), ("c", 3, 3, "{}", False), ("c", 3, 3, "{}", True)), 1)
        assert live._finished(spark, str(tmp_path)) == [0, 1]
        assert [r.vehicle_key for r in spark.read.parquet(f"{tmp_path}/batch={1:012d}").collect()] == ["b"]
    writer(change(("d", 9, 9, "{}", False)), 2)
    assert live._finished(spark, str(tmp_path)) == [1, 2]


def test_sliding_rates_of_a_stream(spark, tmp_path):
    rows = []
    for i in range(120):
        row = dict.fromkeys(METRIC_SCHEMA.names)
        row.update(metric_id=i, metric_timestamp=NOON + timedelta(seconds=37 * i), metric_kind="valid_batch", events_persisted=i)
        rows.append(tuple(row[n] for n in METRIC_SCHEMA.names))
    for part in (rows[:50], rows[50:90], rows[90:]):
        spark.createDataFrame(part, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(METRIC_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = live.stream_sliding_rates(stream, "3 minutes").writeStream.format("parquet")
    out.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    found = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    closed = F.col("window_end") <= F.lit(NOON + timedelta(seconds=37 * 119 - 180))
    batch = metrics.sliding_rates(spark.createDataFrame(rows, METRIC_SCHEMA))
    assert found == {tuple(r) for r in batch.filter(closed).collect()} and len(found) > 60


def observations(spark, n=20_000):
    """Skewed latencies, some invalid; source times of which some lie outside the limit."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    ingested = F.lit(NOON) + F.make_dt_interval(secs=i / 25)
    lag = F.when(i % 50 == 0, F.lit(-5.0)).when(i % 77 == 0, F.lit(90_000.0)).otherwise(noise * noise * 600)
    feed = F.when(i % 31 != 0, ingested - F.make_dt_interval(secs=lag.cast("decimal(18,6)")))
    vehicle = F.when(i % 3 != 0, ingested - F.make_dt_interval(secs=(noise * 100_000).cast("decimal(18,6)")))
    return spark.range(1, n + 1).select(
        i, ingested.alias("ingested_at"), feed.alias("feed_timestamp"), vehicle.alias("vehicle_timestamp")
    )


@pytest.mark.parametrize("minutes", [3, 14])
def test_sketches_stay_within_their_rank_error(spark, minutes):
    rows = observations(spark)
    now = rows.agg(F.max("ingested_at")).first()[0]
    stored = sketches.minute_sketches(rows)
    found = sketches.latency_from_sketches(stored, now, minutes).first()
    first = (now - timedelta(minutes=minutes)).replace(second=0, microsecond=0)
    window = rows.filter(F.col("ingested_at").between(F.lit(first), F.lit(now)))
    exact = window.select(*(e.alias(n) for n, e in metrics.valid_latency(now).items())).collect()
    for kind in ("ingestion_latency", "event_age"):
        values = sorted(r[kind] for r in exact if r[kind] is not None)
        assert abs(found[f"{kind}_count"] - len(values)) <= 0.02 * len(values) * (kind == "event_age")
        assert found[f"{kind}_avg"] == pytest.approx(sum(values) / len(values), rel=0.02 if kind == "event_age" else 1e-6)
        assert found[f"{kind}_max"] == pytest.approx(values[-1], rel=0.02 if kind == "event_age" else 1e-6)
        for name, p in sketches.POINTS.items():
            value = float(found[f"{kind}_{name}"])
            below = sum(v < value - 1e-6 for v in values) / len(values)
            upto = sum(v <= value + 1e-6 for v in values) / len(values)
            assert below - 2 * sketches.RANK_ERROR <= p <= upto + 2 * sketches.RANK_ERROR


def test_sketches_of_parts_merge_and_are_small(spark):
    rows = observations(spark)
    now = rows.agg(F.max("ingested_at")).first()[0]
    parts = [sketches.minute_sketches(rows.filter(F.col("id") % 3 == i)) for i in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = sketches.latency_from_sketches(stored, now, 10).first()
    whole = sketches.latency_from_sketches(sketches.minute_sketches(rows), now, 10).first()
    assert merged.ingestion_latency_count == whole.ingestion_latency_count
    assert merged.ingestion_latency_avg == pytest.approx(whole.ingestion_latency_avg)
    assert merged.ingestion_latency_p95 == pytest.approx(whole.ingestion_latency_p95, rel=0.05)
    assert stored.agg(F.max(F.length("latency_sketch"))).first()[0] < 40_000


def test_window_reads_stored_minutes_only(spark):
    """The plan over stored minutes has no scan of observations, and an empty window has counts of zero."""
    rows = observations(spark, 200)
    stored = sketches.minute_sketches(rows).limit(0)
    empty = sketches.latency_from_sketches(stored, NOON, 5).first()
    assert (empty.ingestion_latency_count, empty.event_age_count, empty.event_age_p50) == (0, 0, None)
    assert metrics.latency_distribution(rows, NOON + timedelta(minutes=1), 5, approx=True).first().ingestion_latency_count > 0
