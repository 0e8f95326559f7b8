"""Streams with state of their own: late rows are kept, PIDs are forgotten."""

import datetime

from utterlake.streaming import ingest, state

HOUR = 3_600_000


def run(spark, tmp_path, batches, ttl=3600):
    rows = lambda b: [(p, None if t is None else datetime.datetime.fromtimestamp(t / 1000, datetime.timezone.utc), "x") for p, t in b]
    for b in batches:
        spark.createDataFrame(rows(b), "pid string, ts timestamp, at string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = ingest.files(spark, f"file://{tmp_path}/in", "pid string, ts timestamp, at string", maxFilesPerTrigger=1)
    q = ingest.run(state.sightings(stream, "pid", "ts", ttl), f"{tmp_path}/state", state.tables(f"{tmp_path}/out"))
    found = {name: sorted(map(tuple, state.read(spark, f"{tmp_path}/out", name).select("pid", "at", "status").collect())) for name in ("seen", "late")}
    return found, q


def test_late_rows_and_forgotten_pids(spark, tmp_path):
    t = 1_700_000_000_000
    batches = [
        [("a", t), ("a", t), ("b", t + 1000), (None, t), ("c", None)],
        [("a", t + HOUR // 2), ("c", t + 5 * HOUR)],  # moves the watermark over b's hour, and over a's
        [("b", t + 2000), ("b", t + 5 * HOUR), ("a", t + 5 * HOUR - 600_001), ("a", t + 5 * HOUR - 600_000)],
    ]
    found, q = run(spark, tmp_path, batches)
    assert found["late"] == [("a", t + 5 * HOUR - 600_001, "late"), ("b", t + 2000, "late")]
    a = [("a", t, "first"), ("a", t, "repeat"), ("a", t + HOUR // 2, "repeat"), ("a", t + HOUR // 2 + HOUR, "expired"), ("a", t + 5 * HOUR - 600_000, "first")]
    b = [("b", t + 1000, "first"), ("b", t + 1000 + HOUR, "expired"), ("b", t + 5 * HOUR, "first")]
    assert found["seen"] == sorted(a + b + [("c", t + 5 * HOUR, "first")])


def test_state_is_let_go(spark, tmp_path):
    """After many PIDs of long ago and one of late, the store holds few."""
    t = 1_700_000_000_000
    found, q = run(spark, tmp_path, [[(f"p{i}", t + i) for i in range(500)], [("z", t + 9 * HOUR)], [("z", t + 9 * HOUR + 1)]])
    assert len(found["seen"]) == 500 * 2 + 2 and not found["late"]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) >= 500 and held[-1] <= 3, held
