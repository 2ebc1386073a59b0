"""Streams over several files and runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gondola.streaming import incremental as op
from gondola.streaming.sessions import SessionTable, run_sessions

SCHEMA = "id int, account int, ts timestamp, v int"


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


@pytest.fixture
def landing(spark, tmp_path):
    """Writes one file per call; the stream takes one file per batch in order."""

    def put(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    return put, stream, str(tmp_path / "out")


def test_ingest_drops_repeated_ids_over_batches_and_runs(landing):
    put, stream, out = landing
    put((1, 1, at(0), 1), (2, 1, at(0, 1), 1))
    put((2, 1, at(0, 1), 1), (3, 1, at(0, 2), 1))
    rows = op.run_append(op.deduplicated(stream(), "id", "ts"), out)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    put((3, 1, at(0, 2), 1), (4, 1, at(0, 3), 1))
    rows = op.run_append(op.deduplicated(stream(), "id", "ts"), out)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3, 4]


def test_windows_keep_the_last_state(landing):
    put, stream, out = landing
    put((1, 1, at(0), 5), (2, 1, at(0, 5), 6))
    put((3, 1, at(0, 7), 7), (4, 2, at(1), 1))
    rows = op.run_update(op.tumbling_counts(stream(), "ts", "1 day", ["account"], "v"), out, ["window_start", "account"])
    assert sorted((r["account"], r["rows"], r["total"]) for r in rows.collect()) == [(1, 3, 18), (2, 1, 1)]


def test_cool_down_over_batches(landing):
    put, stream, out = landing
    put((1, 1, at(0), 1), (2, 1, at(3), 1), (3, 2, at(1), 1))
    put((4, 1, at(7), 1), (5, 1, at(9), 1), (6, 2, at(0), 1))
    put((7, 1, at(14), 1), (8, 2, at(8), 1))
    days = stream().withColumn("day", F.to_date("ts"))
    rows = op.run_append(op.pay_with_cool_down(days, "account", "day"), out)
    assert sorted((r["account"], (r["paid_on"] - dt.date(2024, 1, 1)).days) for r in rows.collect()) == [(1, 0), (1, 7), (1, 14), (2, 1), (2, 8)]


def test_upsert_versions(spark, landing):
    put, stream, out = landing
    put((1, 1, at(0), 5), (2, 1, at(1), 6), (3, 2, at(0), 7))
    put((4, 1, at(2), 8))
    empty = spark.createDataFrame([], SCHEMA)
    rows = op.run_upsert(stream(), out, ["account"], [F.desc("ts"), F.desc("id")], empty)
    assert sorted((r["account"], r["v"]) for r in rows.collect()) == [(1, 8), (2, 7)]
    # again without new data: the same table; then with a change of one key
    rows = op.run_upsert(stream(), out, ["account"], [F.desc("ts"), F.desc("id")], empty)
    assert sorted((r["account"], r["v"]) for r in rows.collect()) == [(1, 8), (2, 7)]
    put((5, 2, at(3), 9), (6, 3, at(0), 1))
    rows = op.run_upsert(stream(), out, ["account"], [F.desc("ts"), F.desc("id")], empty)
    assert sorted((r["account"], r["v"]) for r in rows.collect()) == [(1, 8), (2, 9), (3, 1)]


def test_capacity(landing):
    put, stream, out = landing
    put(*[(i, 1, at(0, 1), 1) for i in range(5)], (9, 1, at(0, 20), 1))
    rows = op.run_update(op.capacity_left(stream(), "ts", 4), out, ["window_end"])
    left = {r["window_end"]: (r["sent"], r["left"]) for r in rows.collect()}
    assert left[at(0, 2)] == (5, 0) and left[at(1, 1)] == (6, 0) and left[at(1, 20)] == (1, 3)


HOUR = 3_600_000_000


def plain_sessions(rows, gap_hours):
    """(account, rows, total) of runs of rows less than a gap apart, by walking over them in order."""
    out = []
    for account in {a for a, *_ in rows}:
        last = None
        for hour, v in sorted((h, v) for a, h, v in rows if a == account):
            if last is None or hour - last >= gap_hours:
                out.append([account, 0, 0])
            out[-1][1] += 1
            out[-1][2] += v
            last = hour
    return sorted(map(tuple, out))


def found_sessions(df):
    return sorted((r["key"], r["rows"], int(r["total"])) for r in df.collect())


def session_table(stream, out, gap, late):
    return SessionTable(stream, out, "account", "ts", F.col("v"), gap * HOUR, late * HOUR)


def test_sessions_merge_over_batches_and_late_rows_are_set_aside(landing):
    put, stream, out = landing
    put((1, 1, at(0, 0), 1), (2, 1, at(0, 5), 2), (3, 2, at(0, 1), 3))
    put((4, 1, at(0, 3), 4), (5, 1, at(0, 9), 5))  # joins two runs of account 1 and goes on
    put((6, 3, at(3), 6))  # closes what is before
    put((7, 1, at(0, 12), 7), (8, 3, at(2, 23), 8), (9, 3, None, 9))  # too late; in time; without a time
    table = session_table(stream(), out, 4, 6)
    got = run_sessions(stream(), table)
    assert found_sessions(got) == [(1, 1, 5), (1, 3, 7), (2, 1, 3), (3, 2, 14)]
    assert {(r["key"], r["closed"]) for r in got.collect()} == {(1, True), (2, True), (3, False)}
    assert sorted(r["id"] for r in table.late_rows().collect()) == [7, 9]
    # what is carried to the next batch is the open session alone
    assert table.open(99).count() == 1


def test_sessions_against_a_walk_over_the_rows(landing):
    import random

    put, stream, out = landing
    draw = random.Random(5)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), draw.randrange(0, 400), draw.randrange(9)) for _ in range(300)]
    rows += rows[:20]
    rows.sort(key=lambda r: r[1] + draw.randrange(20))  # up to 20 hours out of order
    for i in range(0, len(rows), 80):
        put(*[(k, a, at(0, h), v) for k, (a, h, v) in enumerate(rows[i : i + 80])])
    table = session_table(stream(), out, 7, 24)
    got = run_sessions(stream(), table)
    expected = plain_sessions([(a if a is not None else -1, h, v) for a, h, v in rows], 7)
    assert sorted(((r["key"] if r["key"] is not None else -1), r["rows"], int(r["total"])) for r in got.collect()) == expected
    assert table.late_rows().count() == 0
    # a repeated batch replaces itself
    before = sorted(map(str, table.current().collect()))
    last = table._read("mark", table.marks).agg(F.max("batch")).first()[0]
    n = 80 * last
    batch = table.spark.createDataFrame([(k, a, at(0, h), v) for k, (a, h, v) in enumerate(rows[n : n + 80])], SCHEMA)
    table.merge(batch, last)
    assert sorted(map(str, table.current().collect())) == before
