"""Operators of problems 1 to 6 on small inputs: nulls, blanks, ties, repeats, empty tables, clashing names."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brookweave.operators import deletion_vectors as DV
from brookweave.operators import flatten, history, orphans, profile, snapshots
from brookweave.functions.scalars import as_number_text, blank_to_null
from brookweave.plans import data_quality
from brookweave.session import scratch

D = [dt.date(2023, m, 1) for m in (1, 2, 3, 4)]


# --- 1 ---------------------------------------------------------------------------------------------------------------

COLUMNS = (
    profile.ProfiledColumn("v", "number", low=-1e12, high=1e13),
    profile.ProfiledColumn("c", "category", pattern="[A-Z]{3}"),
    profile.ProfiledColumn("i", "category", allowed=(0, 1, 2)),
)


CHANGES = {
    2: (lambda r, k: r.update(v=r["v"] * 20), {("v", "shift")}),
    3: (lambda r, k: r.update(c="EUR"), {("c", "shift")}),
    4: (lambda r, k: r.update(c=" " if k % 4 == 0 else r["c"]), {("c", "missing")}),
    5: (lambda r, k: r.update(c="usd" if k % 4 == 0 else r["c"]), {("c", "pattern")}),
    6: (lambda r, k: r.update(v=1e15 if k % 4 == 0 else r["v"]), {("v", "range")}),
    7: (lambda r, k: r.update(v=None), {("v", "missing")}),
    8: (lambda r, k: r.update(v=100.0 + k % 3), {("v", "distinct")}),
    9: (lambda r, k: r.update(i=2), {("i", "shift")}),
}


def loads(spark, changes=None):
    rng = random.Random(5)
    rows = []
    for day in range(1, 16):
        for k in range(200):
            row = {"id": day * 1000 + k, "day": day, "src": "A", "v": round(rng.lognormvariate(5, 1), 4), "c": rng.choice(["VND", "VND", "USD"]), "i": rng.choice([0, 1])}
            if changes and day in changes:
                changes[day][0](row, k)
            rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, "id bigint, day int, src string, v double, c string, i int")


def issues(df):
    p = profile.quality_profile(df, period="day", source="src", row_id="id", columns=COLUMNS)
    return {(r.day, r.col_name, r.issue) for r in profile.quality_issues(p, "day", "src").collect()}


def test_profile_of_alike_loads_has_no_issue(spark):
    assert issues(loads(spark)) == set()


def test_profile_finds_the_changed_loads(spark):
    assert issues(loads(spark, CHANGES)) == {(day, *i) for day, (_, found) in CHANGES.items() for i in found}


def test_profile_of_an_empty_table(spark):
    empty = loads(spark).where("false")
    assert issues(empty) == set()


def test_profile_keeps_null_loads(spark):
    df = loads(spark).withColumn("src", F.lit(None).cast("string"))
    assert profile.quality_profile(df, period="day", source="src", row_id="id", columns=COLUMNS).count() == 45


def test_area_of_separate_and_equal_sides():
    assert profile.area_under(np.array([0, 0, 9.0]), np.array([5.0, 0, 0])) == 1
    assert profile.area_under(np.array([1.0, 2, 3]), np.array([2.0, 4, 6])) == pytest.approx(0.5)
    assert profile.area_under(np.zeros(3), np.ones(3)) == 0.5


def test_classifier_points_at_the_changed_column(spark):
    """Each changed load is told from its peers, by the column that changed; the others hardly are."""
    df = loads(spark, {2: CHANGES[2], 3: CHANGES[3], 9: CHANGES[9]})
    rows = profile.quality_profile(df, period="day", source="src", row_id="id", columns=COLUMNS).collect()
    found = {(r.day, r.col_name): r for r in rows}
    for day, column in ((2, "v"), (3, "c"), (9, "i")):
        assert found[day, column].area_alone > 0.6 and found[day, column].pointed and found[day, column]["rank"] == 1
    assert all(0.4 < r.area < 0.7 for r in rows if r.day not in (2, 3, 9))


def test_models_are_the_same_in_one_task_and_in_many(spark):
    df = loads(spark, CHANGES)
    cells = profile.pooled_cells(df, "day", "src", "id", COLUMNS)
    one, many = (profile.TwoSample(x, COLUMNS, rounds=3) for x in (cells.coalesce(1), cells.repartition(7)))
    for t in (one, many):
        t.train()
    s = next(iter(one.weights))
    assert np.allclose(one.weights[s], many.weights[s])
    # against plain gradient descent on the same cells of one load and fold
    load, rows = 3, cells.collect()
    own = np.array([sum(x.n0 for x in r.loads if x["_load"] == one.loads[s][load]) for r in rows])
    peers = (np.array([r.pool0 for r in rows]) - own) * one.scales[s][load][0]
    hot = np.zeros((len(rows), int(one.starts[-1])))
    for k, r in enumerate(rows):
        hot[k, np.array(r.codes) + one.starts[:-1]] = 1
    beta = np.zeros(hot.shape[1])
    for _ in range(2000):
        p = 1 / (1 + np.exp(-hot @ beta))
        beta += 0.01 * (hot.T @ (own - (own + peers) * p) - beta)
    done = profile.TwoSample(cells, COLUMNS, rounds=60)
    done.train()
    assert np.abs(hot @ (done.weights[s][0, load] - beta)).max() < 0.1


def test_the_classifier_runs_only_for_its_own_figures(spark, sf, monkeypatch):
    """No issue depends on it: where only issues are asked for nothing is trained, and where it is asked for it decides."""
    df = loads(spark, CHANGES)
    with_test = issues(df)
    areas = lambda high: lambda d, *_: d.sparkSession.createDataFrame(
        [(r[0], c.name, 0.5 + high, 0.5, 0.5 + high) for r in d.select(profile._load_id(F.col("ds_time_id"), F.col("ds_source"))).distinct().collect() for c in data_quality.JOB_COLUMNS],
        "_load bigint, col_name string, area double, area_without double, area_alone double",
    )
    everything = data_quality.p1_profile(spark, sf).where("n_rows > 100").count()
    monkeypatch.setattr(profile, "discrimination", areas(0.0))
    assert data_quality.p1_pointed(spark, sf).count() == 0
    monkeypatch.setattr(profile, "discrimination", areas(0.5))
    assert data_quality.p1_pointed(spark, sf).count() >= everything > 0
    monkeypatch.setattr(profile, "discrimination", lambda *_: pytest.fail("trained for nothing"))
    assert data_quality.p1_found(spark, sf).count() > 0 and data_quality.p1_profile(spark, sf).count() > 0
    plain = profile.quality_profile(df, period="day", source="src", columns=COLUMNS)
    assert {(r.day, r.col_name, r.issue) for r in profile.quality_issues(plain, "day", "src").collect()} == with_test


def test_shift_of_a_load_with_nearly_all_rows(spark):
    """97 % of the rows of a source are one load's: it is no peer of its own."""
    rows = [(k, 1, "A", 1000.0 + k % 7, "VND", 1) for k in range(20_000)]
    rows += [(100_000 * day + k, day, "A", 10.0 + k % 7, "VND", 1) for day in (2, 3, 4) for k in range(200)]
    df = spark.createDataFrame(rows, "id bigint, day int, src string, v double, c string, i int")
    p = profile.quality_profile(df, period="day", source="src", row_id="id", columns=COLUMNS)
    found = {(r.day, r.col_name): r for r in p.collect()}
    assert found[1, "v"].issues == ["distinct", "shift"] and found[1, "v"].area_alone > 0.9 and found[1, "v"].pointed


def test_shift_of_a_median_near_half_zeros(spark):
    """51 of 100 values are zero, 49 in the peers: the median is 0 and the shares hardly differ."""
    rows = [(day * 1000 + k, day, "A", 0.0 if k < (51 if day == 3 else 49) else 1000.0 + k, "VND", k % 2) for day in range(1, 9) for k in range(100)]
    found = issues(spark.createDataFrame(rows, "id bigint, day int, src string, v double, c string, i int"))
    assert {i for i in found if i[2] == "shift"} == {(3, "v", "shift")}


def test_shift_of_small_loads(spark):
    """Loads of 1 to 20 rows against the plain definition."""
    rng = random.Random(8)
    rows = [(day * 1000 + k, day, "A", 100.0 + k, rng.choice(["VND", "VND", "USD", "JPY"]), rng.choice([0, 1])) for day in range(21, 27) for k in range(200)]
    rows += [(day * 1000 + k, day, "A", 100.0 * rng.choice([1, 50]), rng.choice(["VND", "USD", "EUR"]), rng.choice([0, 1, 2])) for day in range(1, 21) for k in range(day)]
    want = set()
    medians = {day: float(np.median([r[3] for r in rows if r[1] == day])) for day in range(1, 27)}
    peer = float(np.median(list(medians.values())))
    want |= {(day, "v", "shift") for day, m in medians.items() if m > 5 * peer or m * 5 < peer}
    for at, name in ((4, "c"), (5, "i")):
        pool = pd.Series([r[at] for r in rows]).value_counts(normalize=True)
        for day in range(1, 27):
            own = pd.Series([r[at] for r in rows if r[1] == day]).value_counts(normalize=True)
            if pool.sub(own, fill_value=0).abs().sum() / 2 > 0.30:
                want.add((day, name, "shift"))
    df = spark.createDataFrame(rows, "id bigint, day int, src string, v double, c string, i int")
    assert (1, "c", "shift") in want and {i for i in issues(df) if i[2] == "shift"} == want


def test_exact_medians(spark):
    rng = np.random.default_rng(1)
    values = [float(x) for x in np.concatenate([rng.lognormal(3, 2, 501), np.zeros(20), -rng.lognormal(3, 2, 100)])] + [5.0] * 30
    df = spark.createDataFrame([(1, "A", v) for v in values] + [(2, "A", v) for v in values[:10]], "day int, src string, v double")
    got = {r._period: r.median_size for r in profile.value_aggregates(df, "day", "src", COLUMNS[0]).collect()}
    assert got[1] == pytest.approx(float(np.median(np.abs(values))))
    assert got[2] == pytest.approx(float(np.median(np.abs(values[:10]))))


# --- 2 and 5 ---------------------------------------------------------------------------------------------------------


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k bigint, a string, b string, end_dt date, rec_st int, src string, on date, load int")


def states(df):
    attributes = {"a": as_number_text(F.col("a")), "b": blank_to_null(F.col("b"))}
    absent = F.coalesce(F.col("rec_st") == 0, F.lit(False)) | F.coalesce(F.col("end_dt") <= F.col("on"), F.lit(False))
    return snapshots.snapshot_states(df, key="k", source="src", date="on", load_time="load", attributes=attributes, absent=absent)


ROWS = [
    (1, "1", "x", None, 1, "S", D[0], 1), (1, "1.0", " x", None, None, "S", D[1], 1), (1, "1", "y", None, 1, "S", D[2], 1), (1, "1", "y", None, 1, "S", D[3], 1),
    (2, "0", None, None, 1, "S", D[0], 1), (2, "0", "", None, 1, "S", D[3], 1),
    (3, "0", "q", None, 1, "S", D[1], 1), (3, "9", "q", None, 0, "S", D[1], 2), (3, "0", "q", D[2], 1, "S", D[2], 1),
    (4, None, "1", None, 1, "S", D[2], 1), (4, "1", None, None, 1, "S", D[3], 1),
    (1, "1", "x", None, 1, "T", D[0], 1), (1, "1", "x", None, 1, "T", D[0], 1),
]


def test_snapshot_changes(spark):
    got = {(r._source, r._key, r._date, r.status, r.diff_key) for r in snapshots.snapshot_changes(states(snapshot(spark, ROWS)), ["a", "b"]).collect()}
    assert got == {
        ("S", 1, D[2], "updated", "b"),
        ("S", 2, D[1], "deleted", ""), ("S", 2, D[3], "new", ""),
        ("S", 4, D[2], "new", ""), ("S", 4, D[3], "updated", "a"), ("S", 4, D[3], "updated", "b"),
    }


def test_snapshot_history(spark):
    got = {(r._source, r._key, r.valid_from, r.valid_to) for r in snapshots.snapshot_history(states(snapshot(spark, ROWS))).collect()}
    assert got == {
        ("S", 1, D[0], D[2]), ("S", 1, D[2], None), ("S", 2, D[0], D[1]), ("S", 2, D[3], None),
        ("S", 4, D[2], D[3]), ("S", 4, D[3], None), ("T", 1, D[0], None),
    }


def test_snapshots_of_nothing(spark):
    assert states(snapshot(spark, [])).count() == 0
    assert snapshots.snapshot_changes(states(snapshot(spark, [])), ["a", "b"]).count() == 0


def test_null_key_and_source_are_kept(spark):
    rows = [(None, "1", "x", None, 1, None, D[0], 1), (None, "1", "z", None, 1, None, D[1], 1), (5, "1", "x", None, 1, "S", None, 1)]
    got = [(r._key, r._source, r.status) for r in snapshots.snapshot_changes(states(snapshot(spark, rows)), ["a", "b"]).collect()]
    assert got == [(None, None, "updated")]


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
def test_update_history_against_a_loop(spark, bucket):
    rng = random.Random(3)
    t0 = dt.datetime(2023, 1, 1)
    rows = [
        (rng.randrange(4) or None, rng.choice(["x", "y", " x", None, ""]), int(rng.random() < 0.15), t0 + dt.timedelta(hours=rng.randrange(0, 3000, 7)), i)
        for i in range(600)
    ]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "k int, a string, del int, at timestamp, load int")
    out = history.update_history(df, key="k", effective="at", load_time="load", attributes={"a": blank_to_null(F.col("a"))}, deleted=F.col("del") == 1, bucket=bucket)
    got = {(r._key, r.valid_from, r.valid_to) for r in out.collect()}
    want, by = set(), defaultdict(dict)
    for k, a, gone, at, load in rows:
        if at not in by[k] or by[k][at][0] <= load:
            by[k][at] = (load, None if gone else ((a or "").strip(),))
    for k, times in by.items():
        last = (None, object())
        for at in sorted(times):
            state = times[at][1]
            if state != last[1]:
                if last[0] is not None and last[1] is not None:
                    want.add((k, last[0], at))
                last = (at, state)
        if last[1] is not None:
            want.add((k, last[0], None))
    assert got == want


# --- 3 ---------------------------------------------------------------------------------------------------------------


def test_orphans_by_mask(spark):
    parents = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), (None, "3")], "x string, y string")
    child = spark.createDataFrame(
        [(1, 20240101, " A ", "1"), (2, 20240101, "a", "2"), (3, 20240101, "a", None), (4, 20240101, None, "9"), (5, None, " ", ""), (6, 20240101, "c", " ")],
        "id int, day int, p string, q string",
    )
    run = lambda m: {r._row for r in orphans.orphan_references(child, "id", "day", [orphans.Reference("t", parents, ["p", "q"], ["x", "y"], m)]).collect()}
    assert run("simple") == {2}
    assert run("partial") == {2, 4, 6}
    assert run("full") == {2, 3, 4, 6}
    with pytest.raises(ValueError):
        orphans.Reference("t", parents, ["p"], ["x", "y"])


@pytest.mark.parametrize("match", ["simple", "partial", "full"])
def test_composite_references_against_a_loop(spark, match):
    """Planted partial nulls in three columns, on both sides, with lives."""
    rng = random.Random(12)
    value = lambda: rng.choice(["a", " A", "b", "c", None, ""])
    t = lambda d: dt.datetime(2024, 1, d)
    parents = [(value(), value(), value(), t(rng.randrange(1, 12)), rng.choice([None, t(rng.randrange(12, 28))]), rng.randrange(2)) for _ in range(25)]
    rows = [(k, rng.choice([20240105, 20240120, None]), value(), value(), value()) for k in range(400)]
    fold = lambda x: (x or "").strip().upper() or None
    want = set()
    for k, day, *parts in rows:
        parts = [fold(x) for x in parts]
        mask = [i for i, x in enumerate(parts) if x is not None]
        if not mask or (match == "simple" and len(mask) < 3):
            continue
        if match == "full" and len(mask) < 3:
            want.add((k, "missing"))
            continue
        met = [p for p in parents if all(fold(p[i]) == parts[i] for i in mask)]
        if not met:
            want.add((k, "missing"))
            continue
        if day is None:
            continue
        number = lambda x: x.year * 10000 + x.month * 100 + x.day
        closes = max(number(p[4]) if p[5] == 0 and p[4] else 99991231 for p in met)
        if min(number(p[3]) for p in met) > day:
            want.add((k, "late"))
        elif closes <= day:
            want.add((k, "deleted"))
    left = spark.createDataFrame(rows, "id int, day int, x string, y string, z string")
    right = spark.createDataFrame(parents, "x string, y string, z string, i timestamp, u timestamp, s int")
    ref = orphans.Reference("t", right, ["x", "y", "z"], ["x", "y", "z"], match, opened="i", closed="u", live="s")
    found = orphans.orphan_references(left, "id", "day", [ref])
    assert {(r._row, r.ref_reason) for r in found.collect()} == want and want


def test_orphan_reasons(spark):
    t = lambda d: dt.datetime(2024, 1, d, 12)
    parents = spark.createDataFrame([("live", t(1), None, 1), ("late", t(9), None, 1), ("dead", t(1), t(5), 0), ("odd", None, None, 0), ("back", t(1), t(3), 1)], "k string, i timestamp, u timestamp, s int")
    child = spark.createDataFrame([(n, 20240105, k) for n, k in enumerate(["live", "late", "dead", "odd", "back", "none", None])], "id int, day int, k string")
    ref = orphans.Reference("t", parents, ["k"], ["k"], opened="i", closed="u", live="s")
    found = orphans.orphan_references(child, "id", "day", [ref])
    assert {(r._row, r.ref_reason) for r in found.collect()} == {(1, "late"), (2, "deleted"), (5, "missing")}
    assert {(r.ref_reason, r.n_rows) for r in orphans.orphan_report(found).collect()} == {("late", 1), ("deleted", 1), ("missing", 1)}
    assert orphans.orphan_references(child.where("false"), "id", "day", [ref]).count() == 0
    assert orphans.orphan_references(child, "id", "day", [orphans.Reference("t", parents.where("false"), ["k"], ["k"])]).count() == 6


# --- 4 ---------------------------------------------------------------------------------------------------------------

FIELDS = ("f", "g")


def feed_rows(seed=1, n=400):
    rng = random.Random(seed)
    kinds = ["cdc_insert", " Update ", "UPDATE", "delete", "noise", None]
    rows = [
        (rng.choice(["a", "b", None]), rng.randrange(3), rng.choice(kinds), rng.choice([None, [], [" F "], ["g", "z"], ["z"], [None]]),
         int(rng.random() < 0.05), str(rng.random())[:4] if rng.random() < 0.9 else None, str(i), rng.randrange(50), i, i, rng.randrange(100))
        for i in range(n)
    ]
    rows += [(*r[:-1], rng.randrange(100)) for r in rows[:60]]
    rng.shuffle(rows)
    return rows


def loop(rows):
    state = {}
    for r in sorted({(r[7], r[8], r[9]): r for r in rows}.values(), key=lambda r: (r[7], r[8], r[9])):
        key, op = (r[0], r[1]), (r[2] or "").strip().lower()
        values = {"f": r[5], "g": r[6]}
        if r[4] == 1 or op == "delete":
            state.pop(key, None)
        elif op == "cdc_insert":
            state[key] = {x: (r[9], values[x]) for x in FIELDS}
        elif op == "update" and key in state:
            names = [(x or "").strip().lower() for x in r[3]] if r[3] else FIELDS
            for x in FIELDS:
                if x in names:
                    state[key][x] = (r[9], values[x])
    return {(*k, x, *v) for k, s in state.items() for x, v in s.items()}


@pytest.mark.parametrize("batches", [1, 4])
def test_feed_with_deletion_vectors_against_a_loop(spark, batches):
    rows = feed_rows()
    df = spark.createDataFrame(rows, "k string, p int, op string, names array<string>, del int, f string, g string, ts int, ix int, id int, load int")
    spec = DV.change_feed(
        keys=("k", "p"), fields=FIELDS, order=("ts", "ix", "id"), operation="op", named="names", deleted="del",
        inserts=("cdc_insert",), updates=("update",), removes=("delete",),
    )
    images = DV.apply_feed(df, spec, scratch(spark, "dv"), arrival="load", batches=batches)
    got = {(r.k, r.p, r.field_name, r.id, r.value) for r in DV.current_fields(images, spec).collect()}
    assert got == loop(rows)
    empty = DV.apply_feed(df.where("false"), spec, scratch(spark, "dv"), arrival="load")
    assert DV.current_fields(empty, spec).count() == 0


def test_vectors_hide_superseded_positions(spark):
    table = DV.VectorTable(spark, scratch(spark, "dv"), ["k"])
    rows = lambda a, b, v: spark.range(a, b).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    table.apply(rows(0, 70000, 1).coalesce(1))
    table.apply(rows(40000, 40010, 2))
    table.apply(rows(40005, 40015, 3))
    live = table.read()
    assert live.count() == 70000
    assert {(r.v, r["count"]) for r in live.groupBy("v").count().collect()} == {(1, 69985), (2, 5), (3, 10)}
    assert table.vectors().agg(F.sum(F.expr("bitmap_count(bitmap)"))).first()[0] == 20


def test_a_vector_table_is_found_again_by_another_process(spark):
    path = scratch(spark, "dv")
    rows = lambda a, b, v: spark.range(a, b).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    with pytest.raises(ValueError):
        DV.VectorTable(spark, path, ["k"]).read()
    DV.VectorTable(spark, path, ["k"]).apply(rows(0, 100, 1))
    DV.VectorTable(spark, path).apply(rows(50, 120, 2))
    again = DV.VectorTable(spark, path)
    assert (again.version, again.keys) == (2, ["k"])
    assert {(r.v, r["count"]) for r in again.read().groupBy("v").count().collect()} == {(1, 50), (2, 70)}
    again._write(rows(0, 7, 9))  # an attempt that died before its commit
    again.apply(rows(0, 10, 3))
    again.apply(rows(0, 10, 3))  # a batch that is handed over twice
    assert {(r.v, r["count"]) for r in DV.VectorTable(spark, path).read().groupBy("v").count().collect()} == {(1, 40), (2, 70), (3, 10)}
    other = DV.VectorTable(spark, path)
    again.compact()
    assert again.vectors() is None and len(again.parts) == 1
    assert {(r.v, r["count"]) for r in DV.VectorTable(spark, path).read().groupBy("v").count().collect()} == {(1, 40), (2, 70), (3, 10)}
    with pytest.raises(RuntimeError):
        other.apply(rows(0, 1, 4))
    DV.VectorTable(spark, path).apply(rows(119, 121, 5))
    assert DV.VectorTable(spark, path).read().count() == 121


def test_keys_named_like_the_index(spark):
    table = DV.VectorTable(spark, scratch(spark, "dv"), ["file", "row", "b"])
    rows = lambda v: spark.createDataFrame([("x", 1, None, v, "d"), ("y", 2, 3, v, "d")], "file string, row int, b int, v int, bucket string")
    table.apply(rows(1))
    table.apply(rows(2).where("row = 1"))
    assert {(r.file, r.row, r.b, r.v) for r in DV.VectorTable(spark, table.path).read().collect()} == {("x", 1, None, 2), ("y", 2, 3, 1)}


def test_a_small_batch_reads_only_the_files_it_supersedes(spark):
    path = scratch(spark, "dv")
    table = DV.VectorTable(spark, path, ["k"])
    table.apply(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")).repartitionByRange(10, "k"))
    batch = spark.createDataFrame([(3, 2), (5, 2)], "k bigint, v int")
    places = table.locate(batch)
    assert len({r["_in_file"] for r in places.collect()}) == 1
    scans = places._jdf.queryExecution().toString()
    assert "PartitionFilters: [b" in scans.replace("isnotnull(b", "b") or "b#" in scans.split("PartitionFilters: [")[1].split("]")[0]


# --- 6 ---------------------------------------------------------------------------------------------------------------


def super_rows(routed):
    return flatten.supertype({name: flatten.subtype_table(routed, name) for name in flatten.SUBTYPES}).collect()


def test_flatten_json_variants(spark):
    docs = [
        (1, '{"a": ["x", " y ", null, "", {"name": "z"}, 5]}'), (2, '{"info": {"a": "solo", "b": [{"name": " n "}, {"role": "r"}, null]}}'),
        (3, '{"a": ["x"'), (4, '{"a": ["x"]} tail'), (5, None), (6, "[1, 2]"), (7, '{"a": null, "b": {"name": "obj"}}'), (8, '{"a": [["deep"]], "b": []}'), (9, ""), (10, '{"info": null, "a": ["q"]}'),
        (11, '{"a": [{"name": {"first": "q"}}, {"name": ["l"]}, {"name": " "}, {"name": 7}], "b": [1.5, true]}'),
    ]
    df = spark.createDataFrame(docs, "id int, j string").select("id", flatten.parse_strict(F.col("j")).alias("d"))
    routed = flatten.flatten_variant_lists(df, parent="t", row_id="id", document=F.col("d"), wrapper="info", paths=("a", "b"))
    assert {(r.parent_id, r.elem_path, r.elem_pos, r.elem_text, r.subtype) for r in super_rows(routed)} == {
        (1, "info.a", 0, "x", "text"), (1, "info.a", 1, "y", "text"), (1, "info.a", 4, "z", "named"), (1, "info.a", 5, "5", "scalar"),
        (2, "info.a", 0, "solo", "text"), (2, "info.b", 0, "n", "named"), (7, "info.b", 0, "obj", "named"), (10, "info.a", 0, "q", "text"),
        (11, "info.a", 3, "7", "named"), (11, "info.b", 0, "1.5", "scalar"), (11, "info.b", 1, "true", "scalar"),
    }
    shapes = {(r.parent_id, r.elem_path): r["shape"] for r in routed.collect()}
    assert shapes[1, "info.a"] == "mixed_list" and shapes[2, "info.a"] == "single" and shapes[2, "info.b"] == "mixed_list" and shapes[10, "info.a"] == "text_list"
    tables = flatten.write_subtypes(routed)
    assert tables["named"].dtypes[-2:] == [("name", "string"), ("fields", "map<string,string>")]
    assert tables["scalar"].dtypes[-1] == ("scalar_number", "double")
    assert {(r.scalar_type, r.scalar_number) for r in tables["scalar"].collect()} == {("BIGINT", 5.0), ("DECIMAL", 1.5), ("BOOLEAN", 1.0)}
    assert {(r.parent_id, r.elem_pos, tuple(sorted(r.fields.items()))) for r in tables["object"].collect()} >= {(2, 1, (("role", "r"),))}


def test_automaton_states(spark):
    cases = {
        "null": "null", '" "': "blank", '"a"': "text", "3": "scalar", "false": "scalar", '{"name": "x"}': "named", '{"name": []}': "object", "{}": "object",
        "[]": "list<>", '["a", null, "b", 2]': "list<null|scalar|text>", '[["a"], [{"name": 1}], []]': "list<list<>|list<named>|list<text>>",
        '[[[["a"]]]]': "list<list<list<list>>>",
    }
    df = spark.createDataFrame(list(cases.items()), "j string, want string").withColumn("got", flatten.node_state(F.parse_json("j")))
    assert [(r.j, r.got) for r in df.collect() if r.got != r.want] == []


def test_flatten_json_with_repeated_keys(spark):
    docs = [(1, '{"a": ["x"], "rank": 1, "rank": 2}'), (2, '{"info": {"a": ["x"], "a": ["y", "z"]}}'), (3, '{"a": [{"name": "p", "name": "q"}]}'), (4, '{"a": ["x"], "a": ["y"]} tail'), (5, '1, "v": {"a": ["x"]}'), (6, '1}, {"v": {"a": ["x"]}')]
    df = spark.createDataFrame(docs, "id int, j string").select("id", flatten.parse_strict(F.col("j")).alias("d"))
    rows = super_rows(flatten.flatten_variant_lists(df, parent="t", row_id="id", document=F.col("d"), wrapper="info", paths=("a",)))
    assert {(r.parent_id, r.elem_pos, r.elem_text) for r in rows} == {(1, 0, "x"), (2, 0, "y"), (2, 1, "z"), (3, 0, "q")}


def test_flatten_maps_and_structs(spark):
    df = spark.createDataFrame(
        [(1, [{"k": "v", "n": None}, None, {"k": " "}, {"m": " w "}]), (2, []), (3, None)], "id int, m array<map<string,string>>"
    )
    routed = flatten.flatten_map_list(df, parent="t", row_id="id", column="m")
    assert {(r.parent_id, r.elem_path, r.elem_pos, r.elem_text) for r in super_rows(routed)} == {(1, "m.k", 0, "v"), (1, "m.m", 3, "w")}
    assert {r["shape"] for r in routed.collect()} == {"ragged_maps"}
    s = spark.createDataFrame([(1, (["a", None, " ", "b"], [])), (2, None)], "id int, info struct<x:array<string>,y:array<string>>")
    rows = flatten.flatten_struct_lists(s, parent="t", row_id="id", record="info", paths=("x", "y"))
    assert {(r.parent_id, r.elem_path, r.elem_pos, r.elem_text) for r in super_rows(rows)} == {(1, "info.x", 0, "a"), (1, "info.x", 3, "b")}
    assert flatten.subtype_table(rows, "text").columns == [*flatten.KEYS, "text_value"]
    assert all(t.count() == 0 for t in flatten.write_subtypes(rows.where("false")).values())
