from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from vigora.operators import lines as L
from vigora.operators import metadata as M
from vigora.operators import render as R
from vigora.operators import structure as S


def units(spark, text, how=S.law_units):
    return how(S.numbered_lines(spark.createDataFrame([("d", text)], "doc_id string, text string"))).orderBy("pos").collect()


def test_references_are_no_articles(spark):
    rows = units(spark, "Art. 1º Caput\no art. 14 desta Lei\nArt. 14 desta Lei\nArt. 2º Outro")
    assert [(r["numero"], r["texto"]) for r in rows] == [("1", "Caput\no art. 14 desta Lei\nArt. 14 desta Lei"), ("2", "Outro")]
    assert list(rows[0]["refs"]) == ["art-14"]


def test_last_noted_wording_is_current(spark):
    rows = units(spark, "Art. 5º Velho\nArt. 5º Novo (Redação dada pela Lei nº 1)\nArt. 6º A (Vide B)\nArt. 6º C\nArt. 7º X\nArt. 7º Y")
    assert [r["vigente"] for r in rows] == [False, True, True, False, False, True]
    assert [r["anterior"] for r in rows] == [1, None, None, 2, 3, None]


def test_breadcrumb_annex_and_divisions(spark):
    text = "LIVRO I\nTÍTULO I\nCAPÍTULO I\nArt. 1º A\nTÍTULO II\nsolto\nArt. 2º B\n\nc\nANEXO I\ntabela\nArt. 3º D"
    rows = units(spark, text)
    assert [(r["numero"], r["breadcrumb"], r["texto"]) for r in rows] == [
        ("1", "LIVRO I > TÍTULO I > CAPÍTULO I", "A"), ("2", "LIVRO I > TÍTULO II", "B\n\nc"), ("3", "LIVRO I > TÍTULO II", "D"),
    ]
    shown = R.headings(S.law_units(S.numbered_lines(spark.createDataFrame([("d", text)], "doc_id string, text string")))).orderBy("pos").collect()
    assert [r["headings"] for r in shown] == ["## LIVRO I\n### TÍTULO I\n#### CAPÍTULO I", "### TÍTULO II", ""]


LEVEL = {"LIVRO": 1, "TÍTULO": 2, "CAPÍTULO": 3, "SEÇÃO": 4, "SUBSEÇÃO": 5}


def read_units(text):
    """Units of a text, read line by line."""
    out, crumb, unit, annex = [], {}, None, False
    for line in (x.strip() for x in text.split("\n")):
        word = line.split(" ")[0] if line else ""
        header = re.match(r"Art\. (\d+) ?(.*)$", line)
        if word == "ANEXO":
            unit, annex = None, True
        elif annex and not header and word not in LEVEL:
            continue
        elif word in LEVEL:
            annex, unit = False, None
            crumb = {k: v for k, v in crumb.items() if k < LEVEL[word]} | {LEVEL[word]: line}
        elif header and not header[2][:1].islower():
            annex = False
            unit = [header[1], " > ".join(crumb[k] for k in sorted(crumb)), [header[2]]]
            out.append(unit)
        else:
            annex = annex and not header
            if unit:
                unit[2].append(line)
    return [(n, c, "\n".join(t).strip()) for n, c, t in out]


def test_parse_against_reading_line_by_line(spark):
    rng = random.Random(4)
    bits = ["LIVRO I", "TÍTULO II", "CAPÍTULO X", "SEÇÃO I", "SUBSEÇÃO V", "ANEXO I", "Art. 1 Um", "Art. 2 Dois", "Art. 3 desta", "corpo", "", "§ 1º x"]
    texts = ["\n".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = {}
    for r in S.law_units(S.numbered_lines(df)).orderBy("pos").collect():
        got.setdefault(r["doc_id"], []).append((r["numero"], r["breadcrumb"], r["texto"]))
    assert got == {str(i): u for i, t in enumerate(texts) if (u := read_units(t))}


def test_subunits_and_bodies(spark):
    text = "Caput\nsegue\n§ 1º Primeiro\nmais\nI - inciso\na) letra\n1) item\nParágrafo único. Só"
    df = S.with_subunits(spark.createDataFrame([(text,)], "t string"), F.col("t"))
    row = df.select("caput", "units", S.body_text(F.col("caput"), F.col("units")).alias("b"), S.body_markdown(F.col("caput"), F.col("units")).alias("m")).first()
    assert row["caput"] == "Caput segue"
    assert [tuple(u) for u in row["units"]] == [(1, "§ 1º", "Primeiro mais"), (2, "I", "inciso"), (3, "a", "letra"), (4, "1", "item"), (1, "Parágrafo único", "Só")]
    assert row["b"] == "Caput segue\n§ 1º Primeiro mais\nI – inciso\na) letra\n1) item\nParágrafo único. Só"
    assert row["m"] == "Caput segue\n\n**§ 1º** Primeiro mais\n  - I – inciso\n    - a) letra\n      - 1) item\n\n**Parágrafo único.** Só"


def test_numbers_and_ids(spark):
    df = spark.createDataFrame([("9",), ("10",), ("3-A",), ("x",)], "n string")
    assert [r[0] for r in df.select(S.display(F.col("n"))).collect()] == ["9º", "10", "3º-A", "x"]
    made = spark.range(1).select(S.unit_id(F.lit("lei-1"), F.lit("art-5"), F.lit(1000))).first()[0]
    assert made == "lei-1--art-5--anterior-1000"
    refs = units(spark, "Art. 1º Vide art. 2 e artigo 10, art. 1º")[0]["refs"]
    assert list(refs) == ["art-10", "art-2"]


def test_accounting_items(spark):
    text = "OBJETIVO\n1. Um item 2\n(a) letra\n(ii) romano\nsolto\n5.4 Hier\nAPÊNDICE A – Guia\nB1. Apx\nALCANCE\n1. De novo\n2. Velho\n2. Novo (Alterado pela Revisão CPC 1)"
    known = spark.createDataFrame([("Alcance",)], "name string")
    rows = units(spark, text, lambda d: S.accounting_units(d, known))
    assert [(r["numero"], r["secao"], r["apendice"], r["vigente"]) for r in rows] == [
        ("1", "OBJETIVO", None, True), ("5.4", "OBJETIVO", None, True), ("B1", "APÊNDICE A – Guia", "B", True),
        ("1", "ALCANCE", None, True), ("2", "ALCANCE", None, False), ("2", "ALCANCE", None, True),
    ]
    assert rows[0]["texto"] == "Um item 2\nsolto" and list(rows[0]["refs"]) == ["item-2"]
    assert [tuple(a) for a in rows[0]["alineas"]] == [("a", "letra")] and [tuple(a) for a in rows[0]["subitens"]] == [("ii", "romano")]


def test_metadata(spark):
    text = "Presidência\nDECRETO Nº 12.955, DE 29 DE ABRIL DE 2026\nRegulamenta a Lei Complementar nº 214\nde 2025 em parte.\nArt. 1º X"
    row = spark.createDataFrame([(text,)], "t string").select(M.identity(F.col("t")).alias("i"), M.summary(F.col("t")).alias("s")).first()
    assert tuple(row["i"]) == ("Decreto", "12955", "2026") and row["s"] == "Regulamenta a Lei Complementar nº 214 de 2025 em parte."
    plain = spark.createDataFrame([("x\nMedida Provisória nº 7 de 1999",)], "t string").select(M.identity(F.col("t")).alias("i")).first()["i"]
    assert tuple(plain) == ("MP", "7", "1999")
    slugs = spark.createDataFrame([("LC 214/2025",), ("Ação  nº_1 ção",), ("日本",)], "v string")
    assert [r[0] for r in slugs.select(M.slug(F.col("v"))).collect()] == [r["s"] for r in M.slug_exact(slugs, "v", "s").collect()] == ["lc-214-2025", "acao-no-1-cao", "norma"]
    assert spark.range(1).select(M.title_case(F.lit("DEMONSTRAÇÃO DOS FLUXOS DE CAIXA"))).first()[0] == "Demonstração dos Fluxos de Caixa"


def test_accounting_titles_and_summaries(spark):
    far = "linha\n" * 300
    head = "PRONUNCIAMENTO TÉCNICO CPC 16 (R1)\n"
    cases = {
        far + head + "Correlação às Normas\nEstoques b\nOBJETIVO": "Objetivo",
        far + head + "Termos de uso deste material que passam de quarenta sinais\nEstoques b Correlação às Normas\nOBJETIVO": "Estoques",
        head + "RECEITA DE CONTRATO SOBRE BENS\nX": "Receita de Contrato sobre Bens",
        "NBC TG 1001, de 2021\nNBC TG 1001 – CONTABILIDADE PARA PEQUENAS EMPRESAS\nx": "Contabilidade para Pequenas Empresas",
        "CONTABILIDADE SEM CABEÇALHO\nx": None,
        None: None,
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").select("i", M.title(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == dict(enumerate(cases.values()))
    item = "O objetivo é prescrever\n o tratamento contábil para os estoques da entidade."
    joined = item.replace("\n ", " ")
    cases = {
        f"OBJETIVO\n1. {item}\n2. Segundo\n": joined,
        f"ALCANCE\n1. {item}\n(a) letra": joined,
        "1. curto\n2. Segundo": None,
        "NBC TG 1001\nAprova a NBC TG 1001, que dispõe sobre a\ncontabilidade.\nOutra.": "dispõe sobre a contabilidade.",
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").select("i", M.accounting_summary(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == dict(enumerate(cases.values()))
    case = lambda x: spark.range(1).select(M.title_case(F.lit(x))).first()[0]
    assert case("Benefícios a Empregados b") == "Benefícios a Empregados" and case("Item b") == "Item B"


def test_empty_documents(spark):
    docs = spark.createDataFrame([("a", None), ("b", ""), (None, "Art. 1º X")], "doc_id string, text string")
    known = spark.createDataFrame([], "name string")
    assert S.law_units(S.numbered_lines(docs)).collect() == [] and S.accounting_units(S.numbered_lines(docs), known).collect() == []
    assert L.split_lines("text") is not None
