import pytest

from tests.oracle import differences, duck
from wakeline import catalog
from wakeline.operators import matching

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duck(SF)
    assert differences(catalog.QUERIES[name](spark, SF), con, catalog.ORACLE_SQL[name]) == ""
    assert con.sql(catalog.ORACLE_SQL[name]).limit(1).fetchall()  # two empty tables would be equal, too


def test_greedy_takes_only_near_places():
    # two places on each side of the target are looked at; with all five taken a sixth row finds none, though others are free
    front = [(float(k), k) for k in range(9)]
    got = matching.greedy([(4.0, 100 + k) for k in range(6)], front, 0.0, 10.0)
    assert [f for _, f, _ in got] == [4, 3, 5, 2, 6]
    # a difference of just the tolerance counts
    assert matching.greedy([(4.0, 1)], [(6.0, 2)], 0.0, 2.0) == [(1, 2, -2.0)] and matching.greedy([(4.0, 1)], [(6.1, 2)], 0.0, 2.0) == []


def test_greedy_groups_equal_the_whole(spark):
    from wakeline.plans import fixtures as fx

    rear, front = fx.lanes(spark, SF)
    sides = [{}, {}]
    for side, df in zip(sides, (rear, front), strict=True):
        for r in df.collect():
            side.setdefault(r[0], []).append((r[2], r[1]))
    for bias in (0.0, -3.5):
        got = sorted((r[0], r[1], r[2]) for r in matching.greedy_pairs(rear, front, 6.0, bias).collect())
        assert got == sorted((k, a, b) for k in sides[0] for a, b, _ in matching.greedy(sides[0][k], sides[1].get(k, []), bias, 6.0))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_nms_keeps_sources_and_moments_apart(spark):
    from wakeline.operators import boxes

    sides = (0.1, 0.1, 0.4, 0.4)
    rows = [(s, t, c, 100 * s + 10 * t + i, 0.9 - i / 10, *sides) for s in (1, 2) for t in (0, 1) for c in (3,) for i in range(3)]
    df = spark.createDataFrame(rows, "source long, frame long, class_id int, box_id long, score double, left double, top double, right double, bottom double")
    assert sorted(r.box_id for r in boxes.nms(df).collect()) == [100, 110, 200, 210]
    rows = catalog._frames(spark, SF)
    stay = catalog.nms(spark, SF).collect()
    frames = {(r.source, r.frame, r.class_id) for r in rows.collect()}
    assert frames == {(r.source, r.frame, r.class_id) for r in stay} and len(stay) < rows.count()


def test_groups_across_batches():
    import pandas as pd

    from wakeline.operators.groups import whole_groups

    rows = pd.DataFrame({"k": [1, 1, 1, 2, None, None, 3, 4, 4, 4, 4, 4], "v": range(12)})
    for cut in (1, 2, 3, 5, 12):
        got = []
        for g, at in whole_groups((rows.iloc[i : i + cut] for i in range(0, 12, cut)), ["k"]):
            got += [g["v"].iloc[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)]
        assert got == [[0, 1, 2], [3], [4, 5], [6], [7, 8, 9, 10, 11]]


def test_best_bias_equals_lists_without_making_them(spark):
    import statistics

    rear = [("a", k, k * 7.0 + k * k % 5 / 10) for k in range(40)] + [("b", 100, 3.0), ("c", 101, 1.0)]
    front = [("a", k, k * 7.0 - 2.5) for k in range(40)] + [("b", 100, 50.0)]
    r, f = (spark.createDataFrame(x, f"key string, {n} long, t double") for x, n in ((rear, "rear_id"), (front, "front_id")))
    out = matching.best_bias(r, f, 1.5, 20.0)
    want = {}
    for key, bias in {tuple(x) for x in matching.candidates(r, f, 20.0).collect()}:
        lists = [[(t, i) for k, i, t in side if k == key] for side in (rear, front)]
        m = matching.greedy(*lists, bias, 1.5) if all(lists) else None
        if m is not None:
            offsets = [x for _, _, x in m]
            rank = (-len(m), round(sum(abs(x - bias) for x in offsets), 6), abs(bias), bias)
            mine = (rank, (bias, len(m), statistics.median(offsets) if m else 0.0))
            want[key] = min(want.get(key, mine), mine)
    assert {x.key: (x.bias, x.matches, round(x.refined, 6)) for x in out.collect()} == {k: (*v[1][:2], round(v[1][2], 6)) for k, v in want.items()}
    assert "collect_list" not in out._jdf.queryExecution().toString()


def test_hours_follow_the_table(spark, tmp_path):
    from pyspark.sql import functions as F

    from wakeline.plans import fixtures as fx

    e = spark.read.parquet(f"{SF}/events.parquet")
    moved = [e.withColumn("ts", (F.col("ts") + F.expr(f"interval {d} days")).cast(e.schema["ts"].dataType)) for d in (-40, 0, 50)]
    moved[0].unionByName(moved[1]).unionByName(moved[2]).write.parquet(f"{tmp_path}/events.parquet")
    for kind in ("click", "view"):
        rows = fx.hourly(spark, str(tmp_path), kind).collect()
        assert sum(r.x for r in rows) == 3 * e.where(F.col("event_type") == kind).count()
        idx = sorted(r.idx for r in rows)
        assert idx == list(range(idx[0], idx[-1] + 1)) and idx[0] <= -24 * 39 and idx[-1] >= 24 * 79
    assert catalog.detrend(spark, str(tmp_path)).count() == len(idx)
