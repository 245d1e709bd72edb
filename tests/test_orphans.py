from __future__ import annotations

import datetime as dt

from vigora.operators import orphans as O

UNIT = "id string, refs array<string>, anexos array<string>, loaded_at timestamp, target string, kind string, period string"


def at(month, day=1):
    return dt.datetime(2025, month, day)


def unit(i, refs=(), anexos=(), when=at(3)):
    return (i, None if refs is None else list(refs), None if anexos is None else list(anexos), when, "t", "k", "p")


def found(spark, units, removals=(), annexes=(), **how):
    df = O.orphans(
        spark.createDataFrame(list(units), UNIT),
        spark.createDataFrame(list(removals), "id string, removed_at timestamp, motivo string"),
        spark.createDataFrame(list(annexes), "slug string, csv string, row_no int"),
        **how,
    )
    return sorted((r["ref_table"], r["id"], r["target"], r["kind"], r["period"]) for r in df.collect())


def test_kinds_spellings_and_periods(spark):
    units = [
        unit("n--art-1", [" ART-2º", "art - 3", "art-9", "", None, "art-9", "art-4", "art-1"], ["a.csv", "b.csv", None, ""]),
        unit("n--art-2", when=at(3)),
        unit("n--art-3", when=at(3, 2)),
        unit("n--art-4", when=at(1)),
        unit("n--art-5", ["art-9"], when=at(1)),
        unit("n--art-6", None, None),
    ]
    removals = [("n--art-4", at(2), None), ("n--art-4", at(2), None), ("n--art-5", at(4), "x"), ("q--art-1", at(4), "x")]
    for keys in (1, 16_384):
        assert found(spark, units, removals, [("n", "a.csv", 1), ("n", "a.csv", 2)], range_keys=keys) == [
            ("annex_cell", "n--art-1", "n/b.csv", "missing", "2025-03"),
            ("chunk", "n--art-1", "n--art-3", "late", "2025-03"),
            ("chunk", "n--art-1", "n--art-4", "deleted", "2025-03"),
            ("chunk", "n--art-1", "n--art-9", "missing", "2025-03"),
        ]


def test_back_again_is_not_deleted_and_redelivery_is_not_late(spark):
    units = [unit("n--art-1", ["art-2"]), unit("n--art-2", when=at(1)), unit("n--art-2", when=at(6))]
    assert found(spark, units, [("n--art-2", at(4), None)]) == []


def test_null_times_null_ids_and_empty_tables(spark):
    units = [unit("n--art-1", ["art-2", "art-7"], when=None), unit("n--art-2", when=None), unit(None, ["art-7"])]
    assert found(spark, units) == [("chunk", "n--art-1", "n--art-7", "missing", None)]
    assert found(spark, []) == []


def test_many_keys_over_bitmap_blocks(spark):
    units = [unit("n--art-0", [f"art-{i}" for i in range(1, 40_001)])] + [unit(f"n--art-{i}") for i in range(1, 40_001, 2)]
    got = found(spark, units, range_keys=10**9)
    assert len(got) == 20_000 and all(int(r[2].rsplit("-", 1)[1]) % 2 == 0 for r in got)
