import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators import caps, filters
from tarmac.plans.schedules import select_landed, select_live


def schedule_frame(spark, rows):
    return spark.createDataFrame(rows, "pos long, flight_iata string, cs_flight_iata string, status string")


def operating_loop(rows):
    """The rule, row by row in input order."""
    registered, kept = set(), []
    for pos, code, shared, _ in sorted(rows):
        if code is None:
            continue
        if shared is not None:
            registered.add(shared)
        elif code not in registered:
            kept.append(pos)
    return kept


@pytest.mark.parametrize("seed", range(5))
def test_codeshares_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    code = lambda p: None if rng.random() < p else f"F{rng.randrange(8)}"
    rows = [(i, code(0.1), code(0.7), "landed") for i in range(60)]
    rng.shuffle(rows)
    kept = filters.drop_codeshares(schedule_frame(spark, rows), "pos")
    assert sorted(r.pos for r in kept.collect()) == operating_loop(rows)


def test_codeshare_before_and_after_its_operating_row(spark):
    rows = [
        (1, "F1", None, "landed"), (2, "X1", "F1", "landed"), (3, "F1", None, "landed"),
        (4, None, "F2", "landed"), (5, "F2", None, "landed"), (6, "F2", None, "landed"),
    ]
    kept = filters.drop_codeshares(schedule_frame(spark, rows), "pos")
    assert sorted(r.pos for r in kept.collect()) == [1, 5, 6]


@pytest.mark.parametrize(
    "statuses, landed, live",
    [
        (["landed", "active", None], [0], [1]),
        (["scheduled", "cancelled", "scheduled"], [0, 1, 2], [0, 2]),
        (["active", "scheduled"], [0, 1], [0]),
        (["cancelled"], [0], []),
        ([], [], []),
    ],
)
def test_preferences(spark, statuses, landed, live):
    df = schedule_frame(spark, [(i, f"F{i}", None, s) for i, s in enumerate(statuses)])
    assert sorted(r.pos for r in select_landed(df, "pos").collect()) == landed
    assert sorted(r.pos for r in select_live(df, "pos").collect()) == live


def test_limit_keeps_input_order(spark):
    df = schedule_frame(spark, [(i, f"F{i}", None, "landed") for i in (5, 3, 9, 1)])
    assert [r.pos for r in select_landed(df, "pos", 2).collect()] == [1, 3]


def test_empty_values(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, v string")
    assert [r.id for r in df.where(filters.not_empty("v")).collect()] == [3]
    assert [r.id for r in df.where(filters.not_empty("v", nulls="keep")).collect()] == [1, 3]


def test_any_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert filters.any_null(df).first()[0] is True
    assert filters.any_null(df.select("id")).first()[0] is False
    assert filters.any_null(df.where("false")).first()[0] is False


def opening_loop(rows, open_below, total):
    taken = []
    for rank in sorted({r for r, _ in rows}):
        if len(taken) >= open_below:
            break
        for row in sorted(p for r, p in rows if r == rank):
            if len(taken) >= total:
                break
            taken.append((rank, row))
    return taken


@pytest.mark.parametrize("seed", range(4))
def test_opening_cap_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(9), i) for i in range(rng.randrange(10, 60))]
    df = spark.createDataFrame(rows, "rank int, pos int")
    got = caps.opening_cap(df, "rank", ["pos"], 12, 20)
    assert [(r["rank"], r.pos) for r in got.collect()] == opening_loop(rows, 12, 20)


@pytest.mark.parametrize("seed", range(3))
def test_priority_cap_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(3), rng.randrange(2), i, rng.random() < 0.4) for i in range(80)]
    taken = []
    for airport in range(3):
        for status in range(2):
            answer = sorted(r for r in rows if r[:2] == (airport, status))[:7]
            taken += [r[:3] for r in answer if r[3]]
    df = spark.createDataFrame(rows, "airport int, status int, pos int, ok boolean")
    got = caps.priority_cap(df, ["airport", "status"], ["pos"], F.col("ok"), 7, 10)
    assert [(r.airport, r.status, r.pos) for r in got.collect()] == taken[:10]


def test_cap_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"), "id")
    capped = caps.cap_per_group(df, ["g"], ["id"], 2)
    assert sorted(r.id for r in capped.collect()) == [0, 1, 9, 19]
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_numbered(spark):
    df = spark.range(500).select((500 - F.col("id")).alias("pos"), (F.col("id") / 3).alias("p")).repartition(7)
    got = caps.numbered(df, ["pos"], "p").orderBy("flight_no").collect()
    assert [r.flight_no for r in got] == list(range(1, 501))
    assert got[0].estimated_minutes == round(499 / 3, 2) and got[-1].estimated_minutes == 0.0


def test_newest(spark):
    df = spark.createDataFrame(
        [(i, None if i == 4 else f"2026-01-0{i}", None if i == 3 else i) for i in range(1, 6)], "_id int, at string, v int"
    )
    got = caps.newest(df, "at", ["_id"], {"_id": "id", "v": "value"})
    assert [tuple(r) for r in got.collect()] == [("5", "5"), ("3", "N/A"), ("2", "2")]
