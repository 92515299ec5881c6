"""Small cases whose results are known."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.functions import routines
from tablewright.operators import derived, partitions, policies, recursion, relational, rules, scale, state
from tablewright.plans.tabledef import Check, Part, Unique, table
from tablewright.sources import parts
from tablewright.streaming import changes as logs

TASKS = [(1, None, None), (2, 1, "T2"), (3, 1, "T1"), (4, 3, "T1"), (5, None, "T3"), (6, 5, "T3"), (7, 5, "T3")]
GOODS = "id int, name string, price int"


@pytest.fixture
def tasks(spark):
    return spark.createDataFrame(TASKS, "id int, parent int, kind string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hierarchy(tasks):
    got = {r.id: (r.path, r.depth, r.root) for r in recursion.hierarchy(tasks, "id", "parent").collect()}
    assert got == {1: ("1", 1, 1), 2: ("2->1", 2, 1), 3: ("3->1", 2, 1), 4: ("4->3->1", 3, 1), 5: ("5", 1, 5), 6: ("6->5", 2, 5), 7: ("7->5", 2, 5)}


def test_cycles_end_and_depth_can_be_limited(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, None)], "src int, dst int")
    start = spark.createDataFrame([(1,)], "node int")
    assert rows(recursion.reachable(edges, start)) == [(1,), (2,), (3,), (None,)]
    with pytest.raises(RecursionError):
        recursion.recurse(start, lambda last: last.select(F.col("node") + 1), max_depth=3)


def test_count_by_kind(tasks):
    assert rows(relational.group_count(tasks, "kind", "kind", more_than=1)) == [("T1", 2), ("T3", 3)]


def test_move_to_the_archive(tasks):
    kept, archive = state.move(tasks, F.col("id") >= 5, tasks.limit(0))
    assert rows(archive) == [(5, None, "T3"), (6, 5, "T3"), (7, 5, "T3")] and kept.count() == 4


def test_merge(spark):
    target = spark.createDataFrame([(i, "T0") for i in (1, 2, 3, 4)], "id int, kind string")
    source = spark.createDataFrame([(i,) for i in (2, 3, 4, 5, 6, 7)], "id int")
    out = state.merge(
        target, source, {"id": "id"},
        [state.matched_delete(F.col("t.id") == 2), state.matched_update({"kind": F.lit("TX")}), state.unmatched_insert({"id": F.col("s.id"), "kind": F.lit("TZ")})],
    )
    assert rows(out.state) == [(1, "T0"), (3, "TX"), (4, "TX"), (5, "TZ"), (6, "TZ"), (7, "TZ")]
    assert sorted(r.op for r in out.changes.collect()) == ["D", "I", "I", "I", "U", "U"]


def test_merge_counts_matches_per_target_row(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, kind string")
    update = [state.matched_update({"kind": F.col("s.kind")})]
    once = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z")], "id int, kind string")
    assert rows(state.merge(target, once, {"id": "id"}, update).state) == [(1, "x"), (1, "x"), (2, "c")]
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "id int, kind string")
    with pytest.raises(state.CardinalityViolation):
        state.merge(target, twice, {"id": "id"}, update)
    idle = [state.matched_update({"kind": F.col("s.kind")}, F.col("s.kind") == "x"), state.matched_nothing()]
    assert rows(state.merge(target, twice, {"id": "id"}, idle).state) == [(1, "a"), (1, "b"), (2, "x")]


def test_inserted_rows_take_defaults(spark):
    defined = table("t", "id int, kind string, n int", defaults={"n": "7"})
    target = spark.createDataFrame([(1, "a", 1)], defined.schema)
    source = spark.createDataFrame([(2,)], "id int")
    out = state.merge(target, source, {"id": "id"}, [state.unmatched_insert({"id": F.col("s.id")})], defined)
    assert rows(out.state) == [(1, "a", 1), (2, None, 7)]
    up = state.upsert(target, spark.createDataFrame([(3, "c")], "id int, kind string"), "id", {"kind": F.col("s.kind")}, definition=defined)
    assert rows(up.state) == [(1, "a", 1), (3, "c", 7)]


def test_upsert(spark):
    users = spark.createDataFrame([(1, "old", "o@x")], "id int, username string, email string")
    new = spark.createDataFrame([(1, "new", "n@x"), (2, "two", "t@x")], users.schema)
    out = state.upsert(users, new, "id", {"username": F.col("s.username"), "email": F.col("s.email")})
    assert rows(out.state) == [(1, "new", "n@x"), (2, "two", "t@x")]
    assert rows(state.upsert(users, new, "id").state) == [(1, "old", "o@x"), (2, "two", "t@x")]


def test_null_keys_never_conflict(spark):
    have = spark.createDataFrame([(None, "a")], "id int, x string")
    new = spark.createDataFrame([(None, "b"), (None, "b"), (1, "d"), (1, "c")], have.schema)
    assert rows(state.upsert(have, new, "id").state) == [(1, "c"), (None, "a"), (None, "b"), (None, "b")]
    ok = new.where("id is null or x = 'c'")
    assert state.upsert(have, ok, "id", {"x": F.col("s.x")}).state.count() == 4


def test_page(tasks):
    assert rows(relational.page(tasks.where("id <= 3"), ["id"], 1, 1)) == [(2, 1, "T2")]


PRICES = partitions.by_range("price", {"p100": (0, 100), "p200": (100, 200), "p300": (200, 300)})


@pytest.fixture
def goods(spark):
    return spark.createDataFrame([(1, "Alice", 84), (2, "Bob", 145), (3, "Jack", 203)], GOODS)


def test_range_routing(spark, goods, tmp_path):
    path = str(tmp_path / "goods")
    parts.write(goods, PRICES, path)
    assert [parts.read_part(spark, path, p).first().id for p in ("p100", "p200", "p300")] == [1, 2, 3]
    late = spark.createDataFrame([(4, "Amy", 345)], GOODS)
    with pytest.raises(Exception, match="no partition for 345"):
        parts.write(late, PRICES, path)
    assert parts.read(spark, path, PRICES).count() == 3
    grown = parts.attach(late, Part("p400", (300,), (400,)), PRICES, path)
    assert parts.read(spark, path, grown).count() == 4
    moved = state.update(goods, {"price": F.lit(96)}, F.col("id") == 3).state
    assert rows(partitions.moved_rows(goods, moved, "id", PRICES)) == [(3, "p300", "p100")]


def test_attach_looks_into_the_default_partition(spark, goods, tmp_path):
    spec, path = partitions.by_range("price", {"p100": (0, 100)}, default="rest"), str(tmp_path / "goods")
    parts.write(goods, spec, path)
    with pytest.raises(rules.RuleViolation, match="rest"):
        parts.attach(goods.limit(0), Part("p200", (100,), (200,)), spec, path)
    with pytest.raises(rules.RuleViolation, match="outside"):
        parts.attach(goods, Part("p500", (400,), (500,)), spec, path)


def test_range_by_date_and_pruning(spark, tmp_path):
    days = spark.createDataFrame([(i, dt.date(2024, 1 + i % 12, 5)) for i in range(48)], "id int, day date")
    spec = partitions.by_range("day", {f"m{m}": (dt.date(2024, m, 1), dt.date(2024 + m // 12, m % 12 + 1, 1)) for m in range(1, 13)})
    path = str(tmp_path / "days")
    parts.write(days, spec, path)
    got = parts.read(spark, path, spec, dt.date(2024, 3, 1), dt.date(2024, 4, 30))
    assert got.count() == 8
    assert "PartitionFilters: [_part" in got._jdf.queryExecution().executedPlan().toString()


def test_hash_routing_places_nulls(spark):
    keys = spark.createDataFrame([(None,), (0,), (7,), (-1,)], "k long")
    assert rows(partitions.route(keys, partitions.by_hash("k", 4, prefix="h"), "p")) == [(-1, "h3"), (0, "h0"), (7, "h3"), (None, "h0")]


def test_inheritance(spark, goods):
    checks = {"p100": "price < 100", "p200": "price >= 100 and price < 200", "p300": "price >= 200 and price < 300"}
    all_ = goods.union(spark.createDataFrame([(4, "Mike", 438)], GOODS))
    routed = partitions.inherit_route(all_, checks, "goods")
    assert [r._table for r in routed.orderBy("id").collect()] == ["p100", "p200", "p300", "goods"]
    moved = state.delete(all_, F.col("id") == 1).state
    moved = partitions.inherit_route(state.update(moved, {"price": F.lit(240)}, F.col("id") == 2).state, checks, "goods")
    assert rows(moved.where("_table = 'p300'").select("id")) == [(2,), (3,)]
    tables = {n: routed.where(F.col("_table") == n).drop("_table") for n in ("goods", *checks)}
    assert rows(partitions.inherit_read(tables, "goods", only=True).select("name")) == [("Mike",)]


def test_equal_ranges(spark, goods):
    spec = partitions.equal_ranges(goods, "price", 50)
    assert [(p.low, p.high) for p in spec.parts] == [((84,), (134,)), ((134,), (184,)), ((184,), (234,))]
    edge = goods.union(spark.createDataFrame([(5, "Edge", 134)], GOODS))
    assert [r.part for r in partitions.split_equal(edge, "price", 50, "part").orderBy("id").collect()] == [1, 2, 3, 2]
    with pytest.raises(ValueError):
        partitions.equal_ranges(goods, "price", 1, most=10)


def test_audit_now_and_at_commit(spark):
    empty = spark.createDataFrame([], "task_id int")
    first = state.insert(empty, spark.createDataFrame([(13,), (14,)], "task_id int"))
    second = state.insert(state.delete(first.state, F.col("task_id") == 14).state, spark.createDataFrame([(15,)], "task_id int"))
    all_ = first.changes.unionByName(second.changes)
    day = F.lit("2024-05-01")
    assert rows(derived.audit_rows(all_, "task_id", day).select("task_id")) == [(13,), (14,), (15,)]
    assert rows(derived.audit_deferred(all_, second.state, "task_id", day).select("task_id")) == [(13,), (15,)]
    assert rows(derived.audit_rows(all_, "task_id", day, number="log_id", last=45).select("log_id", "task_id")) == [(46, 13), (47, 14), (48, 15)]


def test_swap_of_keys(spark):
    defined = table("t", "id int", uniques=(Unique(("id",), name="key", deferrable=True),))
    three = spark.createDataFrame([(1,), (2,), (3,)], defined.schema)
    between = state.update(three, {"id": F.lit(3)}, F.col("id") == 1).state
    assert rows(rules.unique_violations(between, "id")) == [(3, 2)]
    assert rules.violations(between, defined, deferred=False).isEmpty()
    swapped = state.update(three, {"id": F.when(F.col("id") == 1, 3).otherwise(1)}, F.col("id") != 2).state
    assert rules.enforce(swapped, defined).count() == 3


def test_disabled_rules(spark):
    defined = table("t", "id int", checks=(Check("small", "id < 2"),))
    three = spark.createDataFrame([(1,), (2,), (3,)], defined.schema)
    assert rows(rules.violations(three, defined)) == [("small", 2)]
    assert rules.violations(three, defined.disable("small")).isEmpty()
    assert rows(rules.violations(three, defined.disable("small").enable("small"))) == [("small", 2)]


def test_renamed_columns_keep_their_checks(spark):
    defined = table("t", "id int, idle int", checks=(Check("small", "id < idle"),)).rename_column("id", "number")
    assert rules.check_violations(spark.createDataFrame([(3, 2)], defined.schema), defined.checks[0].expression).count() == 1


def test_archive(spark):
    lists = spark.createDataFrame([(i, i in (2, 3, 5)) for i in range(1, 6)], "list_id int, gone boolean")
    items = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 5)], "item_id int, list_id int")
    out = state.archive(lists, items, "list_id", F.col("gone"), F.lit("2024-05-01"))
    assert [sorted(r[0] for r in d.collect()) for d in out] == [[1, 4], [1, 2], [2, 3, 5], [3, 4, 5, 6]]
    got = rows(state.archive_rounds(lists, items, "list_id", F.col("gone"), 2))
    assert got == [(1, 2, 3), (2, 1, 1), (3, 0, 0)]


def log(spark, steps, fields="id int, name string"):
    return spark.createDataFrame([(i, *s) for i, s in enumerate(steps)], f"lsn long, op string, old struct<{fields}>, new struct<{fields}>")


def test_row_filter_of_the_copy_and_of_updates(spark):
    five = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "id int, name string")
    assert rows(logs.initial_copy(five, lambda r: r["id"] > 2).select("id")) == [(3,), (4,), (5,)]
    steps = log(spark, [("U", (1, "a"), (2, "a")), ("U", (1, "a"), (3, "a")), ("U", (3, "a"), (1, "a")), ("U", (3, "a"), (4, "a"))])
    assert rows(logs.row_filter(steps, lambda r: r["id"] > 2).select("lsn", "op")) == [(1, "I"), (2, "D"), (3, "U")]


def test_filter_on_nulls_without_old_rows(spark):
    steps = log(spark, [("U", None, (1, "a")), ("U", None, (2, None)), ("D", (3, None), None)])
    assert rows(logs.row_filter(steps, lambda r: r["name"].isNull()).select("lsn", "op")) == [(1, "U"), (2, "D")]


def test_conflicts(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "id int, name string, origin string")
    steps = [("I", None, (1, "a")), ("U", (2, "b"), (2, "c")), ("D", (9, "z"), None), ("U", (9, "z"), (10, "z")), ("U", (10, "z"), (11, "z")), ("I", None, (10, "n")), ("U", (2, "c"), (1, "c"))]
    got = logs.conflicts(base, log(spark, steps).withColumn("origin", F.lit("y")), "id", base_origin="origin")
    kinds = {}
    for r in got.collect():
        kinds.setdefault(r.lsn, []).append(r.conflict)
    assert kinds[0] == ["insert_exists"] and kinds[1] == ["update_origin_differs"] and kinds[2] == ["delete_missing"]
    assert kinds[3] == ["update_missing"] and kinds[4] == ["update_missing"] and kinds[5] == [None]
    assert "update_exists" in kinds[6]


def test_key_changes_are_replayed(spark):
    base = spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "id int, name string, extra int")
    steps = [("U", (9, "z"), (10, "z")), ("U", (1, "a"), (3, "m")), ("U", (3, "m"), (4, "n")), ("U", (10, "z"), (2, "never")), ("I", None, (5, "new")), ("U", (5, "new"), (6, "newer"))]
    got = logs.apply_changes(base, log(spark, steps), "id", defaults={"extra": F.lit(0)})
    assert rows(got) == [(2, "b", 8), (4, "n", 7), (6, "newer", 0)]


def test_recovery(spark):
    at = [("Iron2", "11:59:57"), ("Iron3", "12:00:58"), ("Iron4", "12:01:49")]
    steps = log(spark, [("U", (1, "x"), (1, n)) for n, _ in at]).withColumn("commit_ts", F.expr("case lsn " + " ".join(f"when {i} then timestamp'2024-01-01 {t}'" for i, (_, t) in enumerate(at)) + " end"))
    steps = steps.withColumn("tx", F.col("lsn") + 100).withColumn("table", F.lit("t"))
    base = spark.createDataFrame([(1, "Iron")], "id int, name string")
    assert rows(logs.recover(base, steps, "id", commit_ts="2024-01-01 12:00:30")) == [(1, "Iron2")]
    assert rows(logs.recover(base, steps, "id", tx=101)) == [(1, "Iron3")]
    assert rows(logs.recover(base, steps, "id", tx=101, inclusive=False)) == [(1, "Iron2")]
    for unknown in ({"tx": 5}, {"name": "nowhere"}):
        with pytest.raises(Exception, match="in the log"):
            logs.recover(base, steps, "id", **unknown).collect()


def test_named_arguments(spark):
    routines.scalar_function(spark, "custom_subtract", {"a": ("int", 1), "b": ("int", 2)}, "int", "a - b")
    assert spark.sql("select custom_subtract(b => 3) as x").first().x == -2


def test_policy(spark):
    people = spark.createDataFrame([(1, "Alice"), (2, "Bob"), (3, "Jack")], "id int, name string")
    own = [policies.Policy("own", ("public",), lambda role: F.lower("name") == role)]
    assert rows(policies.secured(people, "alice", own)) == [(1, "Alice")]
    assert policies.secured(people, "alice", []).count() == 0
    assert policies.secured(people, "boss", own, owner="boss").count() == 3


def test_series_filters(spark):
    series = spark.range(1, 1001).select("id", F.concat(F.lit("TT"), F.col("id").cast("string")).alias("title"), (F.col("id") + 100).alias("user_id"))
    assert series.where(F.lower("title") == "tt100").count() == 1
    assert series.where("id % 20 = 13").count() == 50
    assert tuple(scale.number_rows(series, ["id"]).orderBy(F.desc("rn")).first()) == (1000, "TT1000", 1100, 1000)


def test_stored_view_is_stale_until_refreshed(spark):
    held = {"t": spark.range(11)}
    view = derived.StoredView(spark, lambda: held["t"])
    view.refresh()
    held["t"] = held["t"].where("id <> 10")
    assert view.read().count() == 11
    view.refresh()
    assert view.read().count() == 10
