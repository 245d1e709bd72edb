from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from vigora.operators import packed as P


def test_writings():
    cases = {
        "1234.56 - EX 01, 8471": ["1234.56 Ex 01", "8471"],
        '"9223.39.15, Ex 02","21427178"': ["9223.39.15 Ex 02", "21427178"],
        "“2.2414.6 - EX 03”;“1.1430.23.50”": ["2.2414.6 Ex 03", "1.1430.23.50"],
        "a) 6404; b) 9132 g) 9477.71": ["6404", "9132", "9477.71"],
        "códigos 4262, 35.02 e 5256.21.71 da NCM/SH": ["4262", "35.02", "5256.21.71"],
        "2062.72.78 até 17.10.2032; 1528.72 (nota 8), 7045 (10 un.) (*)": ["2062.72.78", "1528.72", "7045"],
        ";;1234.56.78,, 2345;": ["1234.56.78", "2345"],
        "25.22  5878\t3661.23\r\n5726": ["25.22", "5878", "3661.23", "5726"],
        "91.05/72.24/8088/77.09/0116": ["91.05", "72.24", "8088", "77.09", "0116"],
        "8471.30 e 1.1430 até 5/12/2031": ["8471.30", "1.1430"],
        "3 kg de 10 peças": [],
        "-": [],
    }
    assert {c: P.parse(c)[0] for c in cases} == cases


def test_malformed_quotes_and_brackets_are_flagged_and_read_on():
    assert P.parse('"1234.56; 8471') == (["1234.56", "8471"], 1)
    assert P.parse("(1234.56; 8471") == (["1234.56", "8471"], 2)
    assert P.parse("[1234.56, 8471.30]")[0] == ["1234.56", "8471.30"]
    assert P.parse(None) == ([], 0) and P.parse("") == ([], 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1234.56", "8471", "1.1430.23.50", "12345678", "35.02"]), min_size=1, max_size=30), st.sampled_from([", ", "; ", " / ", "|", "\n", "\t", " ;"]), st.booleans())
def test_round_trip(codes, sep, quote):
    cell = sep.join(f'"{c}"' if quote else c for c in codes)
    assert P.parse(cell) == (codes, 0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="1234.,;\"'“”()[]Ex -a\n", max_size=80))
def test_never_fails(cell):
    codes, flags = P.parse(cell)
    assert flags in range(4) and all(c[0].isdigit() for c in codes)


def test_very_long_cell():
    cell = ", ".join(["1234.56.78"] * 20_000)
    assert len(P.parse(cell)[0]) == 20_000


def test_cells_with_dots_in_every_gap(spark):
    cells = ["8471.30.12. 8471.41.00", "8471.; 8472.", "pos. 8471, pos. 8472", "8471.30"]
    rows = [("a", "x.csv", i, ["NCM"], [c]) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "slug string, csv string, row_no int, header array<string>, cells array<string>")
    got = {(r["row_no"], r["pos"], r["code"]) for r in P.split_codes(df).collect()}
    want = {(i, n, c) for i, x in enumerate(cells) for n, c in enumerate(P.parse(x)[0], 1) if len(P.parse(x)[0]) > 1}
    assert got == want and {i for i, *_ in got} == {0, 1, 2}


def test_cells_of_a_table(spark):
    schema = "slug string, csv string, row_no int, header array<string>, cells array<string>, code string, pos int"
    rows = [
        ("a", "x.csv", 1, ["Item", "ncm"], ["1", "1234.56, 8471"], "z", 9),
        ("a", "x.csv", 1, ["Item", "ncm"], ["1", "1234.56, 8471"], "y", 8),
        ("a", "x.csv", 2, ["Item", "NBS / NCM/SH"], ["1"], "z", 9),
        ("a", "x.csv", 3, ["Item", None], ["1234, 8471", None], "z", 9),
        ("a", "x.csv", 4, None, ["1234, 8471"], "z", 9),
        ("a", "x.csv", 5, ["NCM"], ["8471"], "z", 9),
        (None, "x.csv", 6, ["NCM"], ["1234, 8471"], "z", 9),
    ]
    got = P.split_codes(spark.createDataFrame(rows, schema)).select("row_no", "pos", "code").orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(1, 1, "1234.56"), (1, 2, "8471")]
    assert P.split_codes(spark.createDataFrame([], schema)).collect() == []


def test_brackets_by_nesting():
    assert P.parse("((0101.21.00, 0102.29.00))") == (["0101.21.00", "0102.29.00"], 0)
    assert P.parse("[(8471.30; 8472.10)] 9999.10") == (["8471.30", "8472.10", "9999.10"], 0)
    assert P.parse("(exceto (ver nota) 8471) 8472.10 e 8473") == (["8472.10", "8473"], 0)
    assert P.parse("(8471.30, 8472.10") == (["8471.30", "8472.10"], P.MALFORMED_BRACKET)
    assert P.parse("“‘«\"'8471.30'\"»’” 8472.10") == (["8471.30", "8472.10"], 0)
    deep = "(" * 5_000 + "8471.30, 8472.10" + ")" * 5_000
    assert P.parse(deep) == (["8471.30", "8472.10"], 0)


def test_cells_whose_gaps_hold_dots_and_cells_with_one_code(spark):
    cells = ["1234.56.78. 8765.43.21", "8471.30.12.\n8471.41.10", "8471.30.12", "sem código", None]
    df = spark.createDataFrame([("n", "a.csv", i, ["NCM"], [c]) for i, c in enumerate(cells)], "slug string, csv string, row_no int, header array<string>, cells array<string>")
    assert [(r["row_no"], r["code"]) for r in P.split_codes(df).orderBy("row_no", "pos").collect()] == [(0, "1234.56.78"), (0, "8765.43.21"), (1, "8471.30.12"), (1, "8471.41.10")]
    assert [(r["row_no"], r["code"]) for r in P.split_codes(df, 1).where("row_no >= 2").collect()] == [(2, "8471.30.12")]
