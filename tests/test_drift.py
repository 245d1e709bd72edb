from __future__ import annotations

import datetime as dt
import json

from vigora.operators import drift as R

SCHEMA = "rec_id bigint, feed string, file_no int, line_no int, delivered_at timestamp, body string, kind string, key string, value string"
T0 = dt.datetime(2025, 1, 1)


def load(spark, files, feed="f/anexo_01"):
    rows, n = [], 0
    for no, recs in files.items():
        for line, r in enumerate(recs, 1):
            n += 1
            rows.append((n, feed, no, line, T0, r if r is None or isinstance(r, str) else json.dumps(r), "k", "k", "v"))
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark, files):
    return sorted((r["file_no"], r["change"], r["field"]) for r in R.changes(load(spark, files)).collect())


def recs(**fields):
    return [{"ITEM": str(i), **{k: f(i) for k, f in fields.items()}} for i in range(1, 11)]


def test_added_removed_renamed_retyped(spark):
    files = {
        1: recs(A=lambda i: f"a{i}", N=lambda i: str(i)),
        2: recs(B=lambda i: f"a{i}" if i > 2 else "other", N=lambda i: i),
        4: recs(B=lambda i: None, C=lambda i: [i]),
        5: recs(B=lambda i: 1.5, N=lambda i: {"x": i}),
    }
    assert changes(spark, files) == [
        (2, "renamed", "B"), (2, "retyped", "N"), (4, "added", "C"), (4, "removed", "N"),
        (5, "added", "N"), (5, "removed", "C"), (5, "retyped", "B"), (5, "retyped", "N"),
    ]


def test_too_few_equal_values_are_no_renaming(spark):
    files = {1: recs(A=lambda i: f"a{i}"), 2: recs(B=lambda i: f"a{i}" if i > 3 else "other")}
    assert changes(spark, files) == [(2, "added", "B"), (2, "removed", "A")]


def test_broken_bodies_repeated_files_and_empty_tables(spark):
    one = recs(A=lambda i: i)
    files = {1: [*one, *one, '{"ITEM": "1", "Z"', None, "[1]", "7", ""], 2: [None, "{"], 3: one}
    assert changes(spark, files) == []
    assert changes(spark, {}) == []
    assert R.unify(load(spark, {})).collect() == []


def test_renamed_field_keeps_its_type(spark):
    files = {1: recs(A=lambda i: str(i)), 2: recs(B=lambda i: str(i)), 3: recs(B=lambda i: i)}
    assert changes(spark, files) == [(2, "renamed", "B"), (3, "retyped", "B")]


def test_one_table_with_latest_names_and_joined_types(spark):
    files = {1: recs(A=lambda i: f"a{i}", N=lambda i: str(i)), 2: recs(B=lambda i: f"a{i}", N=lambda i: i)}
    whole = R.unify(load(spark, files)).where("rec_key = '3'").orderBy("file_no").collect()
    assert [r["fields"] for r in whole] == [{"B": "a3", "ITEM": "3", "N": "3"}] * 2
    lines = R.lineage(R.records(load(spark, files)))
    assert {(r["name"], r["kind"]) for r in R.union_schema(lines).collect()} == {("B", "string"), ("ITEM", "string"), ("N", "string")}


def test_a_name_that_comes_back_by_renaming_keeps_both_fields(spark):
    """B leaves, later A is renamed to B: two fields under one name, and a record of the first file holds both."""
    files = {1: recs(A=lambda i: f"a{i}", B=lambda i: i), 2: recs(A=lambda i: f"a{i}"), 3: recs(B=lambda i: f"a{i}")}
    assert changes(spark, files) == [(2, "removed", "B"), (3, "renamed", "B")]
    got = {r["file_no"]: r["fields"] for r in R.unify(load(spark, files)).where("rec_key = '3'").collect()}
    assert got == {1: {"B": "a3", "B@1:B": "3", "ITEM": "3"}, 2: {"B": "a3", "ITEM": "3"}, 3: {"B": "a3", "ITEM": "3"}}
    table = R.feed_table(load(spark, files), "f/anexo_01")
    assert {f.name: f.dataType.simpleString() for f in table.schema if f.name[0] in "BI"} == {"B": "string", "B@1:B": "bigint", "ITEM": "string"}


def test_types_join_in_the_lattice(spark):
    files = {
        1: recs(I=lambda i: i, D=lambda i: i, X=lambda i: i, T=lambda i: f"2024-01-{i:02d}", S=lambda i: f"2024-01-{i:02d}", L=lambda i: [i], M=lambda i: [i], B=lambda i: True, O=lambda i: {"x": i}, Z=lambda i: None),
        2: recs(I=lambda i: i + 1, D=lambda i: i + 0.5, X=lambda i: 1e300, T=lambda i: f"2024-01-{i:02d}T10:00:00", S=lambda i: "later", L=lambda i: [i + 0.5, None], M=lambda i: i, B=lambda i: False, O=lambda i: {"x": 2}, Z=lambda i: None),
    }
    table = R.feed_table(load(spark, files), "f/anexo_01")
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    assert {k: kinds[k] for k in "IDXTSLMBOZ"} == {
        "I": "bigint", "D": "decimal(38,10)", "X": "double", "T": "timestamp_ntz", "S": "string", "L": "array<decimal(38,10)>", "M": "string", "B": "boolean", "O": "variant", "Z": "string",
    }
    one = {r["file_no"]: r for r in table.where("rec_key = '3'").drop("O").collect()}
    assert (one[1]["I"], float(one[1]["D"]), one[1]["X"], one[1]["S"], one[1]["M"], one[1]["B"], one[1]["Z"]) == (3, 3.0, 3.0, "2024-01-03", "[3]", True, None)
    assert one[1]["T"] == dt.datetime(2024, 1, 3) and one[2]["T"] == dt.datetime(2024, 1, 3, 10) and [float(x) for x in one[1]["L"]] == [3.0] and one[2]["M"] == "3"


def test_columns_that_clash_with_the_keys(spark):
    files = {1: recs(Rec_Key=lambda i: i, line_no=lambda i: "x")}
    table = R.feed_table(load(spark, files), "f/anexo_01")
    assert set(table.columns) == {"rec_id", "file_no", "line_no", "rec_key", "ITEM", "Rec_Key_", "line_no_"}
