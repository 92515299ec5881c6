"""Laws that hold for any data: splits of a log, merges of replicas, round trips, hot keys, plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablewright.functions.aggregates import weighted_mean
from tablewright.operators import layout, neighbours, policies, replicas, scale, state
from tablewright.sources import copy_text, export, versions
from tablewright.streaming import changes as logs
from tablewright.streaming.jobs import Subscriber

FIELDS = "id int, x int"
LOG = f"lsn long, op string, old struct<{FIELDS}>, new struct<{FIELDS}>"
TABLE = "id int, x int, extra string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_log(seed, n=60):
    draw, out = random.Random(seed), []
    for i in range(n):
        op = draw.choice("IUUUD")
        k, x = draw.randrange(8), draw.randrange(100)
        if op == "I":
            out.append((i, "I", None, (k, x)))
        elif op == "D":
            out.append((i, "D", (k, 0), None))
        else:
            out.append((i, "U", (k, 0), (draw.randrange(8) if draw.random() < 0.2 else k, x)))
    return out


def replay(base, log):
    now = {r[0]: r for r in base}
    for _, op, old, new in log:
        if op == "I":
            now[new[0]] = (*new, None)
        elif op == "D":
            now.pop(old[0], None)
        elif old[0] in now:
            row = now.pop(old[0])
            now[new[0]] = (*new, row[2])
    return sorted(now.values(), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_any_split_of_a_log_gives_the_replayed_state(spark, seed):
    log, base = random_log(seed), [(i, i, f"e{i}") for i in range(0, 8, 2)]
    want = replay(base, log)
    for cuts in ([], [30], [13, 41]):
        now = spark.createDataFrame(base, TABLE)
        for a, b in zip([0, *cuts], [*cuts, len(log)]):
            got = rows(logs.apply_changes(now, spark.createDataFrame(log[a:b], LOG), "id", truncates=False))
            now = spark.createDataFrame(got, TABLE)
        assert got == want


def test_a_difference_applied_gives_the_new_version(spark, tmp_path):
    a = spark.createDataFrame([(i, i % 3) for i in range(20)], FIELDS)
    b = spark.createDataFrame([(i, i % 4) for i in range(5, 30)], FIELDS)
    two = [versions.store(v, str(tmp_path / n), "id", 4) for n, v in (("a", a), ("b", b))]
    step = export.increment(*two, 1)
    assert rows(export.combine(a, [step], "id")) == rows(b)
    assert logs.diff(a, a, "id").isEmpty()


def test_archive_keeps_all_rows(spark):
    parents = spark.createDataFrame([(i, i % 2 == 0 if i % 5 else None) for i in range(30)], "id int, gone boolean")
    children = spark.createDataFrame([(i, i % 30) for i in range(100)], "c int, id int")
    out = state.archive(parents, children, "id", F.col("gone"), F.lit(1))
    assert out.parents.count() + out.archived_parents.count() == 30
    assert out.children.count() + out.archived_children.count() == 100


def test_replica_merges_do_not_depend_on_order_or_repeats(spark):
    draw = random.Random(1)
    states = [(draw.randrange(3), draw.randrange(4), draw.randrange(9), draw.randrange(5), draw.random() < 0.3) for _ in range(60)]
    schema = "k int, replica int, v int, at int, gone boolean"
    once = spark.createDataFrame(states, schema)
    twice = spark.createDataFrame(random.Random(2).sample(states * 2, 120), schema)
    for merge in (lambda d: replicas.g_counter(d, "k", "replica", "v"), lambda d: replicas.pn_counter(d, "k", "replica", "v", "at"), lambda d: replicas.lww_map(d, "k", "v", "at", "replica", "gone"), lambda d: replicas.g_set(d, "k", "v"), lambda d: replicas.g_map(d, "k", "at", "v")):
        assert rows(merge(once)) == rows(merge(twice))


def test_copy_text_round_trip(spark, tmp_path):
    texts = ["plain", "tab\there", "line\nbreak", "back\\slash", "\\N", "\\\\t", "\\t", "\r\n", "", None, "é  \x0b\x0c\x08", "\\.", "end\\"]
    df = spark.createDataFrame([(i, t, i / 7, i % 2 == 0) for i, t in enumerate(texts)], "id int, t string, x double, b boolean")
    copy_text.write(df, str(tmp_path / "copy"))
    assert rows(copy_text.read(spark, str(tmp_path / "copy"), df.schema)) == rows(df)
    export.export({"a": df, "b": df.limit(0)}, str(tmp_path / "export"))
    assert rows(export.restore(spark, str(tmp_path / "export"), "a")) == rows(df)
    assert export.restore(spark, str(tmp_path / "export"), "b").count() == 0


def test_end_marker_is_no_row(spark, tmp_path):
    (tmp_path / "f.txt").write_text("1\ta\n2\t\\N\n\\.\n")
    assert rows(copy_text.read(spark, str(tmp_path), spark.createDataFrame([], "id int, t string").schema)) == [(1, "a"), (2, None)]


def test_aggregate_keys_stay_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(big, 1.0, 1.0), (big + 1, 2.0, 1.0), (None, 3.0, 1.0), (big, 5.0, 3.0), (None, None, 1.0)], "k long, v double, w double").repartition(3)
    got = {r.k: r["mean"] for r in weighted_mean().over(df, "k", ["v", "w"]).collect()}
    assert got == {big: 4.0, big + 1: 2.0, None: 3.0}


# hot keys: the slots are given, as a small frame has no hot key by itself


def skewed(spark):
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id").repartition(8)


def test_hot_keys_are_found_by_their_rows(spark):
    found = scale.hot_keys(skewed(spark), "k", rows_per_task=200)
    hot = spark.range(1).select(scale.key_hash("id").alias("h")).first().h
    assert found == {hot: -(-sum(r.k == 0 for r in skewed(spark).collect()) // 200)}
    assert scale.hot_keys(skewed(spark), "k", rows_per_task=10**6) == {} == scale.hot_keys(skewed(spark).limit(0), "k")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_joins_give_the_plain_result(spark, how):
    big, keyed = skewed(spark), spark.createDataFrame([(0, "zero"), (7, "seven")], "k long, name string")
    hot = scale.hot_keys(big, "k", rows_per_task=200)
    assert rows(scale.spread_join(big, keyed, "k", how, hot=hot)) == rows(big.join(keyed, "k", how))
    only_keys = big.select("k")
    spread = scale.spread_join(only_keys, keyed.select("k"), "k", "left_semi", hot=hot)
    assert spread.count() == only_keys.where("k in (0, 7)").count()


def test_equal_rows_of_a_hot_key_go_to_several_tasks(spark):
    same = spark.range(2000).select(F.lit(0).cast("long").alias("k")).repartition(8)
    hot = scale.hot_keys(same, "k", rows_per_task=500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scale.spread_join(same, spark.createDataFrame([(0, 1)], "k long, v int"), "k", hot=hot)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2000 and len(sizes) > 1


def test_previous_value_of_hot_keys(spark):
    df = skewed(spark).withColumn("v", F.when(F.col("id") % 5 > 0, F.col("id") * 2))
    hot = scale.hot_keys(df, "k", rows_per_task=200)
    args = ("k", "id", F.col("v"), "before")
    assert rows(scale.previous_value(df, *args, hot=hot)) == rows(scale.previous_value(df, *args, hot={}))
    marked = dict(when=F.col("v").isNotNull())
    assert rows(scale.previous_value(df, *args, hot=hot, **marked)) == rows(scale.previous_value(df, *args, hot={}, **marked))


def test_numbers_are_complete_and_in_order(spark):
    df = skewed(spark)
    got = scale.number_rows(df, ["-k", "id"]).orderBy("rn").collect()
    assert [r.rn for r in got] == list(range(1, 3001))
    assert [(r.k, r.id) for r in got] == sorted(((r.k, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert scale.number_rows(df.limit(0), ["id"]).count() == 0


# plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 7).alias("x"), F.lit("a").alias("name")).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_filters_reach_the_scan(spark, stored):
    hit = F.col("x") < 3
    policy = [policies.Policy("p", ("public",), lambda role: hit)]
    frames = [state.delete(stored, hit).changes, state.update(stored, {"name": F.lit("b")}, hit).changes, state.delete(stored, hit).removed, policies.secured(stored, "r", policy), logs.initial_copy(stored, lambda r: r["x"] < 3, ["id"])]
    for df in frames:
        assert "LessThan(x,3)" in plan(df), plan(df)


def test_numbering_shuffles_once(spark, stored):
    numbered = scale.number_rows(stored, ["id"])
    # Only the frame of partition sizes, one row each, moves: the rows are read and numbered where they are.
    assert "BroadcastHashJoin" in plan(numbered) and "SortMergeJoin" not in plan(numbered) and "rangepartitioning" not in plan(numbered)


def test_semi_join_and_columns(spark, stored):
    keys = stored.select((F.col("id") * 2).alias("id"))
    out = scale.spread_join(stored, keys, "id", "left_semi", hot={}).select("id")
    assert "LeftSemi" in plan(out)
    assert "name" not in plan(stored.select("id")).split("ReadSchema")[1]


def test_nearest_for_several_points(spark):
    draw = random.Random(4)
    df = spark.createDataFrame([(i, [draw.random() for _ in range(4)]) for i in range(60)], "id int, v array<float>").repartition(5)
    points = {1: [0.0] * 4, 2: [1.0] * 4}
    asked = spark.createDataFrame(list(points.items()), "query int, vector array<float>")
    got = neighbours.nearest_each(df, "v", "id", asked, 5).collect()
    for q, p in points.items():
        want = [r.id for r in layout.nearest(df, "v", "id", p, 5).collect()]
        assert [r.id for r in sorted((r for r in got if r.query == q), key=lambda r: r["rank"])] == want


# streams


def staged(spark, folder, log, cuts):
    for a, b in zip([0, *cuts], [*cuts, len(log)]):
        spark.createDataFrame(log[a:b], LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")


def test_stream_gives_the_batch_result_and_catches_up(spark, tmp_path):
    log, base = random_log(9), [(i, i, f"e{i}") for i in range(4)]
    table = spark.createDataFrame(base, TABLE)
    follower = Subscriber(spark, f"{tmp_path}/to", "id", table.schema)
    follower.start_from(table)
    staged(spark, tmp_path, log[:30], [10, 20])
    schema = spark.createDataFrame([], LOG).schema
    follower.follow(f"{tmp_path}/log", schema)
    assert rows(follower.read()) == replay(base, log[:30])
    staged(spark, tmp_path, log[30:], [])  # arrived while the subscriber paused
    again = Subscriber(spark, f"{tmp_path}/to", "id", table.schema)
    again.follow(f"{tmp_path}/log", schema)
    assert rows(again.read()) == replay(base, log)


def test_stream_stops_at_a_conflict_and_resumes_after_repair(spark, tmp_path):
    table = spark.createDataFrame([(1, 1, "a")], TABLE)
    log = [(0, "I", None, (1, 5)), (1, "I", None, (2, 6)), (2, "D", (9, 0), None)]
    schema = spark.createDataFrame([], LOG).schema
    follower = Subscriber(spark, f"{tmp_path}/to", "id", table.schema, stop_at_conflicts=True)
    follower.start_from(table)
    staged(spark, tmp_path, log, [])
    with pytest.raises(Exception, match="conflicts with the table"):
        follower.follow(f"{tmp_path}/log", schema)
    assert rows(follower.read()) == [(1, 1, "a")]
    follower.start_from(table.where("id <> 1"))
    follower.follow(f"{tmp_path}/log", schema)
    assert rows(follower.read()) == [(1, 5, None), (2, 6, None)]


def test_drift_stops_the_stream(spark):
    log = spark.createDataFrame([(0, "I", None, (1, 5))], LOG)
    with pytest.raises(logs.SchemaDrift):
        logs.check_drift(log, spark.createDataFrame([], "id int, other int").schema)


def test_neighbours_without_query_rows(spark, tmp_path):
    """No row 7 and no id divisible by 100: no neighbours, and no error."""
    from tablewright.catalogue import QUERIES

    spark.createDataFrame([(1, [0.0, 1.0], 0)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["knn_topk"](spark, str(tmp_path)).count() == 0
    assert QUERIES["knn_each"](spark, str(tmp_path)).count() == 0
