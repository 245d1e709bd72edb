from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vigora.operators import annexes as A
from vigora.operators import catalogs as C
from vigora.operators import retrieval as X
from vigora.operators import validation as V
from vigora.plans import catalog
from vigora.sources import files
from vigora.streaming import ingest

CELLS = "slug string, csv string, row_no int, header array<string>, cells array<string>"


def test_chains_of_any_length(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(66)], "src int, dst int")
    got = X.chain(edges).where("start = 0").agg(F.max("depth"), F.count("target")).first()
    assert tuple(got) == (66, 66)


def test_routing_numbering_and_stitching(spark):
    rows = [("n", "a.csv", i, ["Item", "", "NCM"], ["1", None]) for i in range(1, 5)]
    rows += [("n", "b.csv", i, ["x", "y"], ["1", "2", "3"][:2]) for i in range(1, 8)]
    rows += [("n", "c.csv", 1, ["41", "8479.89"], ["9", "1234.56.78"])]
    held = A.distinct_rows(spark.createDataFrame(rows, CELLS))
    assert {r["csv"]: r["to_csv"] for r in A.routing(held).collect()} == {"a.csv": True, "b.csv": False, "c.csv": False}
    assert [tuple(r) for r in A.numbering(A.routing(held)).collect()] == [("n", "a.csv", "anexo_01.csv")]
    assert {r["csv"]: r["table_no"] for r in A.stitch(held).collect()} == {"a.csv": 1, "b.csv": 2, "c.csv": 2}
    assert A.markdown_rows(held).where("csv = 'a.csv'").first()["line"] == "| 1 |  |  |"
    assert [r["code"] for r in A.code_lookup(held).collect()] == ["1234.56.78"]


def test_catalog_lookup_and_subjects(spark):
    rows = [("CPC 26 (R1)", ["irpf", "tributario-federal"], False, "2026-07-21"), ("B", None, True, "2026"), ("C", [], None, None)]
    df = spark.createDataFrame(rows, "codigo string, assunto array<string>, no_repo boolean, data string")
    assert {r["target"]: (r["codigo"], r["outcome"]) for r in C.flip(df, ["cpc  26", "b", "z"]).collect()} == {
        "cpc  26": ("CPC 26 (R1)", "found"), "b": ("B", "already"), "z": (None, "missing"),
    }
    assert {r["codigo"]: r["section"] for r in C.first_subject(df).collect()} == {"CPC 26 (R1)": 2, "B": 0, "C": 0}
    assert [r["codigo"] for r in C.chronological(df).collect()] == ["C", "B", "CPC 26 (R1)"]


def test_chains_end_in_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "x"), ("y", "y")], "src string, dst string")
    got = {(r["start"], r["target"]): r["depth"] for r in X.chain(edges).collect()}
    assert got[("a", "d")] == 3 and got[("b", "a")] == 2 and ("a", "a") not in got and len(got) == 9


def test_router_and_periods(spark):
    docs = spark.createDataFrame([(1, "IRPF e rural"), (2, None), (3, "nada")], "k int, t string")
    triggers = spark.createDataFrame([("tax", "irpf", 1), ("farm", "rural", 2), ("farm", None, 2)], "skill string, trigger string, priority int")
    assert [tuple(r) for r in X.route(docs, "k", "t", triggers, 10).collect()] == [(1, "tax", 1)]
    more = spark.createDataFrame([("tax", "irpf", 1), ("farm", "rural", 2), ("farm", "e r", 2), ("none", "xyz", 0)], "skill string, trigger string, priority int")
    for size in (1, 2, 10):  # several passes give what one gives
        assert [tuple(r) for r in X.route(docs, "k", "t", more, size).collect()] == [(1, "farm", 2)]
    assert X.route(docs, "k", "t", triggers.where("false")).collect() == []
    rows = spark.createDataFrame([(1, "2025-01-01", None), (2, "2025-01-01", "2025-02-01")], "k int, a string, b string")
    assert [r["k"] for r in X.valid_on(rows, "a", "b", "2025-03-01").collect()] == [1]


def test_validation(spark):
    df = spark.createDataFrame([("SeguranÃ§a",), ("Segurança",), (None,)], "t string")
    assert [r[0] for r in df.select(V.mojibake(F.col("t"))).collect()] == [True, False, None]


def test_files_round_trip(spark, tmp_path):
    units = spark.createDataFrame([("lei-1--art-1", "Lei 1", None)], "id string, norma string, apendice string")
    files.write_units(units, str(tmp_path / "u"))
    line = next(t for p in (tmp_path / "u").glob("*.json") if (t := p.read_text()))
    assert json.loads(line) == {"id": "lei-1--art-1", "norma": "Lei 1", "apendice": None}
    assert files.read_units(spark, str(tmp_path / "u")).first()["norma"] == "Lei 1"
    folder = tmp_path / "lei-1" / "anexos"
    folder.mkdir(parents=True)
    (folder / "anexo_01.csv").write_text('Item,Texto\n1,"a\nb"\n2,c,d\n')
    got = files.read_annexes(spark, str(folder)).orderBy("row_no").collect()
    assert [(r["slug"], r["csv"], r["row_no"], r["cells"]) for r in got] == [("lei-1", "anexo_01.csv", 1, ["1", "a\nb"]), ("lei-1", "anexo_01.csv", 2, ["2", "c", "d"])]
    (tmp_path / "lei-1" / "lei-1.meta.json").write_text('{"identificador": "Lei 1",\n "numero": "1"}')
    assert files.read_metas(spark, str(tmp_path / "lei-1" / "*.meta.json")).first()["slug"] == "lei-1"
    (tmp_path / "scripts").mkdir()
    (tmp_path / "scripts" / "x.json").write_text("{}")
    assert [(r["folder"], r["name"]) for r in files.list_files(spark, str(tmp_path), "*.json").where("folder <> 'u'").collect()] == [("lei-1", "lei-1.meta.json")]
    rows = spark.createDataFrame([("d", 2, "1", "fim"), ("d", 0, "", "---\n# D\n"), ("e", 0, "", "E")], "doc_id string, part int, place string, markdown string")
    files.write_document(rows, str(tmp_path / "md"))
    assert "".join(p.read_text() for p in (tmp_path / "md" / "doc_id=d").glob("*.txt")) == "---\n# D\n\nfim\n"
    with pytest.raises(ValueError):
        files.rewrite(units, "/x", "/x/")


def test_stream_keeps_the_last_delivery(spark, tmp_path):
    rows = [("a", "n", dt.datetime(2025, 1, 1), 1), ("a", "n", dt.datetime(2025, 1, 2), 2), ("b", "n", dt.datetime(2025, 1, 1), 3)]
    schema = "id string, norma string, loaded_at timestamp, v int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.arriving(spark, str(tmp_path / "in"), schema)
    ingest.keep_last(ingest.distinct_arrivals(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 2), ("b", 3)]
    later = [("a", "n", dt.datetime(2025, 1, 3), 4), ("c", "n", dt.datetime(2025, 1, 1), 5), ("b", "n", dt.datetime(2024, 12, 31), 6)]
    spark.createDataFrame(later, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.keep_last(ingest.distinct_arrivals(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    merged = sorted((r["id"], r["v"]) for r in ingest.last_kept(spark, str(tmp_path / "out")).collect())
    assert merged == [("a", 4), ("b", 3), ("c", 5)]
    ingest.compact(spark, str(tmp_path / "out"), str(tmp_path / "one"))
    assert sorted((r["id"], r["v"]) for r in ingest.last_kept(spark, str(tmp_path / "one")).collect()) == merged


def test_targets_take_entries_in_order(spark):
    rows = [(1, "NBC TG 26", "CPC 26 (R1)", False), (2, "CPC 26", None, True), (3, "X", "Y", None)]
    df = spark.createDataFrame(rows, "pos int, codigo string, correspondencia_cpc string, no_repo boolean")
    got = {r["target"]: (r["codigo"], r["outcome"]) for r in C.flip(df, ["cpc 26", "CPC  26", "CPC 26 (R2)", "y"], "correspondencia_cpc", "pos").collect()}
    assert got == {"cpc 26": ("NBC TG 26", "found"), "CPC  26": ("CPC 26", "already"), "CPC 26 (R2)": (None, "missing"), "y": ("X", "found")}
    assert tuple(C.flip_report(C.flip(df, ["cpc 26", "z"], "correspondencia_cpc", "pos")).first()) == (1, 0, 1)
    assert C.flip(df, []).collect() == []


def test_longer_numbers_are_no_prefix(spark):
    codes = spark.createDataFrame([("1000.11.22",), ("0007.00.00",)], "code string")
    parts = spark.createDataFrame([(1000, "a"), (10000, "b"), (10007, "c"), (7, "d"), (None, "e")], "k bigint, name string")
    assert sorted((r["code"], r["name"]) for r in X.prefix_join(codes, parts, "code", "k", 4).collect()) == [("0007.00.00", "d"), ("1000.11.22", "a")]


def test_accounting_catalog_sections(spark):
    rows = [
        ("NBC TG 2", "B", "NBC TG", None, False, None, "CPC 2"), ("NBC TG 10", "A", "NBC TG", None, True, None, None), ("ITG 1000", "P", "ITG", None, True, None, None),
        ("ITG 2000", "I", "ITG", "revogada", False, "NBC TG 2", None), ("NBC TA Estrutura", "E", "NBC TA", None, True, None, None), ("NBC TA 450", "R", "NBC TA", "revogada", False, None, None),
        ("NBC TA 900", "N", "NBC TA", None, True, None, None), ("NBC TO 1", "O", "NBC TO", None, True, None, None), ("ZZ 1", "Z", "ZZ", None, True, None, None),
    ]
    df = spark.createDataFrame(rows, "codigo string, titulo string, familia string, situacao string, no_repo boolean, revogada_por string, correspondencia_cpc string")
    assert [(r["section"], r["line"]) for r in C.accounting_lines(df).collect()] == [
        (1, "| NBC TG 10 | — | A | [OK] |"), (1, "| NBC TG 2 | CPC 2 | B | [  ] |"), (2, "| ITG 1000 | P | [OK] |"), (3, "| ITG 2000 | I | [REV] (rev. NBC TG 2) |"),
        (8, "| NBC TA Estrutura | E | [OK] |"), (8, "| NBC TA 450 | R | [REV] |"), (9, "| NBC TO 1 | NBC TO | O | [OK] |"),
    ]


def test_regimes_revocations_and_states(spark):
    rows = [("A", "CPC 1", "a", "vigente", ["pme"], ["B"], None, True), ("B", None, "b", "Revogada", ["pme", "geral"], None, "A", True), ("C", None, "c", None, ["geral"], [], "A", False)]
    df = spark.createDataFrame(rows, "codigo string, correspondencia_cpc string, titulo string, situacao string, aplicacao array<string>, revoga array<string>, revogada_por string, no_repo boolean")
    assert [(r["codigo"], r["warning"], r["rank"]) for r in X.correspondence(df, "pme").collect()] == [("A", None, 0), ("B", "revogada por A", 2)]
    assert sorted(map(tuple, X.revocations(df).collect())) == [("A", "B"), ("A", "C")]
    events = [("x", "opção", "regular", "2026-01-10", "2026-02-01", None, False), ("x", "opção", "outro", "2026-03-10", "2026-04-01", None, True), ("y", "opção", "regular", "2026-01-01", "2026-01-01", "2026-02-01", None)]
    held = spark.createDataFrame(events, "k string, evento string, regime string, data_evento string, efeito string, fim string, cancelado boolean")
    assert [(r["k"], r["regime"]) for r in X.state_on(held, ["k"], "2026-05-01").collect()] == [("x", "regular")]
    assert {r["k"] for r in X.state_on(held, ["k"], "2026-01-15").collect()} == {"y"}
    classes = spark.createDataFrame([("01.11-3", "cereais"), ("99.99-9", "só")], "classe string, nome string")
    subs = spark.createDataFrame([("0111-3/01", "arroz"), ("0111-3/02", "milho")], "subclasse string, descricao string")
    taxes = spark.createDataFrame([("0111-3/01", "I")], "subclasse string, anexo string")
    assert sorted((r["nome"], r["descricao"] or "", r["anexo"] or "") for r in X.hierarchy(classes, subs, taxes).collect()) == [("cereais", "arroz", "I"), ("cereais", "milho", ""), ("só", "", "")]


def test_tables_of_an_extractor(spark):
    head = ["Item", "", "NCM"]
    tables = [
        ("n", 1, 1, [["Sumário", "p."], ["Item 1", "2"]]), ("n", 3, 1, [head, *[[str(i), None, " x "] for i in range(4)]]), ("n", 3, 2, [["a", "b"], ["1", "2"], ["3"]]),
        ("n", 5, 1, [["h"], *[[str(i)] for i in range(8)]]), ("n", 6, 1, [["only"]]), ("n", 7, 1, None), (None, 1, 1, [head, head]),
    ]
    rows = A.from_page_tables(spark.createDataFrame(tables, "slug string, page int, table_no int, rows array<array<string>>"), 2).collect()
    held = {}
    for r in rows:
        held.setdefault((r["csv"], r["to_csv"], tuple(r["header"])), []).append((r["row_no"], r["cells"]))
    assert {k: len(v) for k, v in held.items()} == {("anexo_01.csv", True, ("Item", "col1", "NCM")): 4, ("3_2", False, ("a", "b")): 2, ("anexo_02.csv", True, ("h",)): 8}
    assert sorted(held["anexo_01.csv", True, ("Item", "col1", "NCM")])[0] == (1, ["0", "", "x"])


def test_annex_text_in_a_unit(spark):
    from vigora.operators import structure as S

    text = "Art. 1º Texto\nlinha do anexo que é longa o bastante\nANEXO I\nlinha do anexo que é longa o bastante\noutra linha do anexo, só dele"
    lines = S.numbered_lines(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    assert [tuple(r) for r in V.annex_leaks(S.classify_law(lines), S.law_units(lines)).collect()] == [("d", 2, 1)]


def test_checkpoints_need_a_shared_folder_off_a_local_master():
    from vigora.sources import tables

    class Undefined:
        def isDefined(self):
            return False

    class Session:
        class sparkContext:
            master = "spark://host:7077"
            _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Undefined()})()})()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        tables.ensure_checkpoint_dir(Session)


def test_registry():
    assert catalog.queries().keys() >= catalog.oracle_sql().keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys()
