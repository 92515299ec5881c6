"""Block join of nearest rows and doubling of hierarchies against plain versions."""

from __future__ import annotations

import numpy as np
import pytest

from tablewright.operators import neighbours, recursion


def brute(rows, points, k):
    out = set()
    for q, p in points:
        near = sorted((round(float(np.sqrt(((np.float32(v).astype(float) - np.float32(p)) ** 2).sum())), 6), i) for i, v in rows if v is not None)
        out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("spread", [0.01, 5.0])
def test_nearest_blocks(spark, spread):
    draw = np.random.default_rng(3)
    centres = draw.normal(0, 10, (12, 3))
    rows = [(i, (centres[i % 12] + draw.normal(0, spread, 3)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(2000, None)]  # copies are ties: the smaller keys stay
    points = [r for r in rows if r[0] % 50 == 5] + [(9000, [100.0, 100.0, 100.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    asked = spark.createDataFrame([*points, (9001, None)], "query long, vector array<float>")
    report = {}
    got = neighbours.nearest_each(df, "v", "id", asked, 7, block_rows=10, report=report).collect()
    assert {(r.query, r["rank"], r.id, round(r.distance, 6)) for r in got} == brute(rows, points, 7)
    assert len(got) == 7 * len(points)
    if spread < 1:  # blocks beyond the radius are skipped
        assert report["met"] < report["pairs"] / 3


def test_nearest_fewer_rows_than_asked(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    asked = spark.createDataFrame([(7, [0.9])], "query long, vector array<double>")
    got = neighbours.nearest_each(df, "v", "id", asked, 5).collect()
    assert [(r.query, r["rank"], r.id) for r in sorted(got, key=lambda r: r["rank"])] == [(7, 1, 2), (7, 2, 1)]
    assert neighbours.nearest_each(df.limit(0), "v", "id", asked, 5).count() == 0
    assert neighbours.nearest_each(df, "v", "id", asked.limit(0), 5).count() == 0


def test_deep_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    rounds = []
    plain = recursion.materialize
    monkeypatch.setattr(recursion, "materialize", lambda df, name: rounds.append(name) or plain(df, name))
    df = spark.range(1, 1001).selectExpr("id", "case when id > 1 then id - 1 end as up")
    got = {r.id: (r.depth, r.root, r.up) for r in recursion.hierarchy(df, "id", "up", path=None).collect()}
    assert got == {i: (i, 1, i - 1 if i > 1 else None) for i in range(1, 1001)}
    assert len(rounds) <= 12


def test_hierarchy_without_root(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 99, "d"), (5, 4, "e")], "id long, up long, name string")
    got = sorted((r.id, r.path, r.depth, r.root, r.up, r.name) for r in recursion.hierarchy(df, "id", "up", ["name"]).collect())
    assert got == [(1, "1", 1, 1, None, "a"), (2, "2->1", 2, 1, 1, "b"), (3, "3->2->1", 3, 1, 2, "c")]
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "id long, up long")
    with pytest.raises(RecursionError):
        recursion.hierarchy(ring, "id", "up").collect()
