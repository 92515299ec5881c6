"""Checks and differences that look at touched keys or ranges only, against the full ones; stored postings."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import deltas, layout, rules
from tablewright.sources import versions
from tablewright.streaming import changes as logs


def changed(draw, rows, n, make):
    """A random change of a list of rows: (old, new) images, and the rows after it."""
    rows, log = list(rows), []
    for _ in range(n):
        kind = draw.choice("IUD")
        old = draw.choice(rows) if kind != "I" and rows else None
        new = make() if kind != "D" else None
        if old is not None:
            rows.remove(old)
        if new is not None:
            rows.append(new)
        if old is not None or new is not None:
            log.append((old, new))
    return log, rows


@pytest.mark.parametrize("seed", range(3))
def test_delta_rules_equal_the_full_check(spark, seed):
    draw = random.Random(seed)
    parents = [(i,) for i in range(20)]
    children = [(draw.choice([*range(20), None]), i) for i in range(40)]
    p_log, p_after = changed(draw, parents, 12, lambda: (draw.choice([*range(25), None]),))
    c_log, c_after = changed(draw, children, 15, lambda: (draw.choice([*range(25), None]), draw.randrange(100)))
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    P, C = "k long", "k long, v long"
    pl, cl = frame(p_log, "old struct<k:long>, new struct<k:long>"), frame(c_log, "old struct<k:long,v:long>, new struct<k:long,v:long>")
    got = {tuple(r) for r in deltas.unique_violations(frame(parents, P), pl, "k").collect()}
    assert got == {tuple(r) for r in rules.unique_violations(frame(p_after, P), "k").collect()}
    got = {tuple(r) for r in deltas.foreign_key_violations(frame(children, C), cl, frame(parents, P), pl, "k", "k").collect()}
    assert got == {tuple(r) for r in rules.foreign_key_violations(frame(c_after, C), frame(p_after, P), "k", "k").collect()}
    only = {tuple(r) for r in deltas.foreign_key_violations(frame(children, C), None, frame(parents, P), pl, "k", "k").collect()}
    assert only == {tuple(r) for r in rules.foreign_key_violations(frame(children, C), frame(p_after, P), "k", "k").collect()}


def test_a_swap_breaks_nothing(spark):
    swap = spark.createDataFrame([((1,), (2,)), ((2,), (1,))], "old struct<k:long>, new struct<k:long>")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    assert deltas.unique_violations(rows, swap, "k").isEmpty()
    assert deltas.foreign_key_violations(rows, None, rows, swap, "k", "k").isEmpty()


def test_only_ranges_that_differ_are_read(spark, tmp_path):
    a = spark.range(1000).selectExpr("id", "id % 7 as v", "case when id % 3 > 0 then 'x' end as t")
    b = a.where("id <> 205").withColumn("v", F.expr("case when id in (17, 18) then null else v end")).unionByName(spark.createDataFrame([(5000, 1, "y")], a.schema))
    one, two = (versions.store(v, str(tmp_path / n), "id", 10) for n, v in (("a", a), ("b", b)))
    assert versions.differing(one, two) == [1, 20, 500]
    step = logs.diff_versions(one, two)
    assert {(r.op, r.old.id if r.old else None, r.new.id if r.new else None) for r in step.collect()} == {("U", 17, 17), ("U", 18, 18), ("D", 205, None), ("I", None, 5000)}
    # The filter is one of folders, so the other ranges are never opened.
    plan = one.within([1, 20, 500])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_leaf#\d+L? IN \(1,20,500\)", plan)
    assert one.within([1, 20, 500]).count() == 20
    assert versions.differing(one, one) == []
    assert one.rows.exceptAll(a).isEmpty() and one.rows.columns == a.columns


def test_versions_by_other_keys_and_without_rows(spark, tmp_path):
    a = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int")
    one, two = (versions.store(v, str(tmp_path / n), "k", 16) for n, v in (("a", a), ("b", a.limit(0))))
    assert {r.op for r in logs.diff_versions(one, two).collect()} == {"D"}
    assert logs.diff_versions(two, one).count() == 50


def test_stored_postings(spark, tmp_path):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    texts = [(i, " ".join(draw.choices(words, weights=range(1, 13), k=6))) for i in [*range(60), -5, 100000]]
    docs = spark.createDataFrame([*texts, (7000, None), (7001, "")], "id long, text string")
    layout.store_postings(layout.postings(docs, "id", "text"), "id", str(tmp_path / "p"), 16)
    blocks = spark.read.parquet(str(tmp_path / "p"))
    assert blocks.agg(F.max("n")).first()[0] <= 16
    asked = [(q, w) for q in range(10) for w in draw.sample(words, 1 + q % 3)] + [(10, "w1"), (10, "none")]
    got = {tuple(r) for r in layout.search_postings(blocks, spark.createDataFrame(asked, "query long, token string"), "id").collect()}
    want = {q: {w for p, w in asked if p == q} for q, _ in asked}
    assert got == {(q, i) for q, terms in want.items() for i, text in texts if terms <= set(text.split())}
