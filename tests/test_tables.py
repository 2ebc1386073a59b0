"""Merge-on-read tables, expiring state, bucketed tables, merged profiles, and how few pairs names make."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gondola.operators import contracts, standardise
from gondola.plans import sources
from gondola.plans.registry import Tables
from gondola.streaming import incremental, merge_on_read

SCHEMA = "id int, at int, v string"


def size(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


@pytest.fixture
def table(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)

    def build(**options):
        return merge_on_read.MergeTable(spark, str(tmp_path / "table"), empty.schema, ["id"], [F.desc("at"), F.desc("v")], **options)

    return build


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batches_merge_as_in_a_dictionary(spark, table):
    t, want, rng = table(most_deltas=3, ratio=0.7), {}, random.Random(1)
    kinds = set()
    assert rows(t.read()) == []
    for number in range(14):
        batch = [(rng.randrange(60), rng.randrange(100), f"{number}-{i}") for i in range(rng.choice([0, 1, 30, 2]))]
        if number in (0, 9):  # makes a base that outweighs the next deltas
            batch += [(k, 1, f"{number}:{k}") for k in range(100, 1500 * (number + 1))]
        df = spark.createDataFrame(batch, SCHEMA)
        t.append(df, number)
        if number % 4 == 0:  # run again after a failure
            t.append(df, number)
        for key in {b[0] for b in batch}:
            want[key] = max((b for b in batch if b[0] == key), key=lambda b: (b[1], b[2]))
        kinds.add(t.compact())
        if number % 5 == 0:  # the same batch once more after it was folded in
            t.append(df, number)
        assert rows(t.read()) == sorted(want.values())
    assert kinds == {"", "delta", "base"}
    assert len(t._whole("base")) <= 2 and len(t._whole("delta")) <= 12


def test_a_batch_writes_in_proportion_to_itself(spark, table):
    t = table(part_bytes=1 << 18)
    t.append(spark.range(200_000).selectExpr("CAST(id AS INT) AS id", "0 AS at", "md5(CAST(id AS STRING)) AS v"), 0)
    assert t.compact() == "base"
    base = size(t.folder)
    assert len(list(Path(t.folder, "base", "0").glob("*.parquet"))) > 8  # the number of files follows the size
    for number in (1, 2, 3):
        before = size(t.folder)
        t.append(spark.createDataFrame([(number * 1000, number, "new"), (-number, 1, "more")], SCHEMA), number)
        assert t.compact() == ""
        assert size(t.folder) - before < base / 200
    assert t.read().count() == 200_003
    assert rows(t.read().filter("v in ('new', 'more')")) == [(-3, 1, "more"), (-2, 1, "more"), (-1, 1, "more"), (1000, 1, "new"), (2000, 2, "new"), (3000, 3, "new")]


def test_half_written_folders_do_not_count(spark, table):
    t = table()
    t.append(spark.createDataFrame([(1, 1, "a")], SCHEMA), 0)
    spark.createDataFrame([(1, 2, "b", 5)], SCHEMA + ", _batch long").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{t.folder}/delta/1-1")
    Path(t.folder, "delta", "1-1", "_SUCCESS").unlink(missing_ok=True)
    assert rows(t.read()) == [(1, 1, "a")]


def test_stream_restarts(spark, table, tmp_path):
    source, state, t = str(tmp_path / "in"), str(tmp_path / "state"), table()

    def put(*batch):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        return rows(merge_on_read.run_merge(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), t, state))

    put((1, 1, "a"), (2, 1, "a"))
    put((1, 0, "late"))
    assert run() == [(1, 0, "late"), (2, 1, "a")]  # a later batch counts
    assert run() == [(1, 0, "late"), (2, 1, "a")]
    put((3, 1, "c"))
    assert run() == [(1, 0, "late"), (2, 1, "a"), (3, 1, "c")]


def test_state_ends_with_the_cool_down(spark, tmp_path):
    source, day0 = str(tmp_path / "in"), dt.datetime(2024, 1, 1, 6)
    schema = "account int, ts timestamp"

    def put(*batch):
        data = [(a, day0 + dt.timedelta(days=d)) for a, d in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    def run(out, **options):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).withColumn("day", F.to_date("ts"))
        paid = incremental.run_append(incremental.pay_with_cool_down(stream, "account", "day", **options), out)
        state = spark.read.format("statestore").load(f"{out}/state")
        return sorted((r["account"], (r["paid_on"] - day0.date()).days) for r in paid.collect()), state.count()

    put(*[(a, 0) for a in range(50)])
    put(*[(a, 5) for a in range(25)], (100, 6))
    put((0, 7), (100, 12), (101, 30))
    put((101, 31), (102, 60))
    kept, all_states = run(str(tmp_path / "kept"))
    ended, states = run(str(tmp_path / "ended"), at="ts")
    assert ended == kept == sorted([*[(a, 0) for a in range(50)], (0, 7), (100, 6), (101, 30), (102, 60)])
    assert all_states == 53 and states <= 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = sources.bucketed_totals(Tables(spark, "/root/testdata/sf0.001"), 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()


def test_profiles_merge(spark):
    df = spark.range(60_000).selectExpr(
        "id", "CAST(id % 997 AS STRING) AS few", "CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN 'x' END AS gaps", "id / 7 AS x", "CAST(NULL AS STRING) AS none")
    stored = contracts.sketch_profile(df, F.col("id") % 20)
    assert stored.count() == 100
    got = {r["column"]: r for r in contracts.merged_profile(stored, (0.1, 0.5)).collect()}
    want = {r["column"]: r for r in contracts.profile(df).collect()}
    for c in want:
        assert (got[c]["total"], got[c]["completeness"]) == (want[c]["total"], want[c]["completeness"])
        assert abs(got[c]["uniqueness"] - want[c]["uniqueness"]) <= 0.05 * want[c]["uniqueness"]
    assert got["few"]["quantiles"] is None and got["none"]["uniqueness"] == 0
    assert got["id"]["quantiles"] == pytest.approx([6000, 30000], rel=0.1)
    assert got["x"]["quantiles"] == pytest.approx([6000 / 7, 30000 / 7], rel=0.1)


def test_a_word_in_all_names_makes_few_pairs(spark):
    """Every name holds `comprimido`, some few others; brute force says which pairs are similar enough."""
    rng = random.Random(5)
    names = ["comprimido " + " ".join(f"word{min(int(rng.paretovariate(0.5)), 3000)}x" for _ in range(rng.randint(3, 7))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    words = [{w for w in n.split() if len(w) > 2 and not w.isdigit()} for n in names]
    for low in (0.15, 0.3, 0.6):
        sets = standardise._word_sets(df)
        met = standardise.set_pairs(sets, sets, low).count()
        truth = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if low <= round(len(a & b) / len(a | b), 6) < 0.95}
        found = {(r["left_id"], r["right_id"]) for r in standardise.similar_name_pairs(df, df, low).collect()}
        assert found == truth
        distinct = len({frozenset(w) for w in words})
        assert met <= 3 * (len(truth) + distinct) and (low < 0.6 or met < distinct**2 / 4)
