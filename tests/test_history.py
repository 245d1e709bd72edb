from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from vigora.operators import history as H

SCHEMA = "snapshot_date date, id string, norma string, artigo string, vigente boolean, notas_vigencia array<string>, loaded_at timestamp, _row int"


def row(month, unit, artigo="1", vigente=True, notes=(), hour=0, norma="Lei 1/2000"):
    day = dt.date(2025, month, 1)
    at = dt.datetime(2025, month, 1, hour)
    return (day, unit, norma, artigo, vigente, None if notes is None else list(notes), at, 7)


def found(spark, rows, every=4):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r)[:3] for r in H.unit_history(df, every).select("id", "valid_from", "valid_to").collect())


def test_change_absence_and_return(spark):
    rows = [row(1, "a--1"), row(2, "a--1", notes=["x"]), row(3, "b--1"), row(4, "a--1", notes=["x"])]
    assert found(spark, rows) == [
        ("a--1", "2025-01-01", "2025-02-01"),
        ("a--1", "2025-02-01", "2025-03-01"),
        ("a--1", "2025-04-01", "9999-12-31"),
        ("b--1", "2025-03-01", "2025-04-01"),
    ]


def test_spelling_nulls_and_late_corrections_make_no_version(spark):
    rows = [
        row(1, "a--1", artigo="3-a", notes=[" n  1", "n 2", None, ""]),
        row(2, "a--1", artigo=" 3º-A", notes=["n 2", "n 1", "n 1"]),
        row(3, "a--1", artigo="9", hour=1),
        row(3, "a--1", artigo=None, vigente=None, notes=["n 1", "n 2"], hour=5),
        row(3, "a--1", artigo=None, vigente=None, notes=["n 1", "n 2"], hour=5),
    ]
    assert found(spark, rows) == [("a--1", "2025-01-01", "9999-12-31")]


def test_null_and_empty_notes_are_the_same_and_other_norms_say_nothing(spark):
    rows = [row(1, "a--1", notes=None), row(2, "z--1", norma="Lei 2/2000"), row(3, "a--1", notes=[])]
    assert found(spark, rows)[0] == ("a--1", "2025-01-01", "9999-12-31")


def test_unplaced_rows_and_empty_table(spark):
    rows = [(None, "a--1", "n", "1", True, [], dt.datetime(2025, 1, 1), 1), (dt.date(2025, 1, 1), None, "n", "1", True, [], None, 1)]
    assert found(spark, rows) == [] and found(spark, []) == []


def test_null_load_time_loses(spark):
    late = (dt.date(2025, 1, 1), "a--1", "Lei 1/2000", "2", True, [], None, 1)
    df = spark.createDataFrame([late, row(1, "a--1", artigo="1")], SCHEMA)
    assert [r["artigo"] for r in H.unit_history(df).collect()] == ["1"]


def brute(rows):
    """Versions by reading each unit's snapshots in order."""
    last, dates = {}, {}
    for day, unit, norma, artigo, vigente, notes, at, _ in rows:
        dates.setdefault(norma, set()).add(day)
        if (unit, day) not in last or at >= last[unit, day][0]:
            last[unit, day] = (at, norma, artigo, vigente, frozenset(notes or ()))
    out = []
    for unit in sorted({u for u, _ in last}):
        norma = next(v[1] for (u, _), v in last.items() if u == unit)
        state = start = None
        art = vig = None
        for day in sorted(dates[norma]):
            now = last.get((unit, day))
            if now:
                art, vig = now[2] if now[2] is not None else art, now[3] if now[3] is not None else vig
            value = (art, vig, now[4]) if now else None
            if value != state:
                if state is not None:
                    out.append((unit, str(start), str(day)))
                state, start = value, day
        if state is not None:
            out.append((unit, str(start), "9999-12-31"))
    return sorted(out)


def test_random_snapshots_against_brute_force_for_every_checkpoint_distance(spark):
    rng = random.Random(3)
    rows = []
    for month in range(1, 11):
        for norm in ("n", "m"):
            if rng.random() < 0.2:
                continue
            for unit in range(12):
                if rng.random() < 0.8:
                    notes = [x for x in "ab" if rng.random() < 0.3]
                    rows.append(row(month, f"{norm}--{unit}", rng.choice(["1", "1", "2", None] if month > 1 else ["1"]), rng.choice([True, True, False]), notes, unit, norm))
    want = brute(rows)
    assert all(found(spark, rows, every) == want for every in (1, 2, 4))


def test_log_holds_only_what_changes(spark):
    rows = [row(m, "a--1", notes=["x"] * (m % 2)) for m in range(1, 9)]
    log = H.unit_log(spark.createDataFrame(rows, SCHEMA), 4).orderBy("at").collect()
    assert [r["kind"] for r in log] == ["full", "patch", "patch", "patch", "full", "patch", "patch", "patch"]
    assert all(r["artigo"] is None and r["changed"] == ["notas"] for r in log if r["kind"] == "patch")


def test_as_of(spark):
    rows = [row(1, "a--1"), row(3, "a--1", vigente=False)]
    state = H.as_of(H.unit_log(spark.createDataFrame(rows, SCHEMA)), "id", H.ATTRS, "2025-02-15")
    assert [r["vigente"] for r in state.select(F.col("vigente")).collect()] == [True]


def test_as_of_a_day_equals_the_folded_history(spark):
    rng = random.Random(9)
    rows = [row(m, f"n--{u}", rng.choice(["1", "2"]), rng.choice([True, False]), [x for x in "ab" if rng.random() < 0.4], u, "n") for m in range(1, 11) for u in range(10) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, SCHEMA)
    for every in (1, 4):
        log, history = H.unit_log(df, every).cache(), H.unit_history(df, every).cache()
        for day in ("2024-12-31", "2025-01-01", "2025-04-20", "2025-12-31"):
            want = history.where((F.col("valid_from") <= day) & (F.col("valid_to") > day)).select("id", "valid_from", *H.ATTRS)
            assert sorted(map(tuple, H.as_of(log, "id", H.ATTRS, day).collect())) == sorted(map(tuple, want.collect()))
