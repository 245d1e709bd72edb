from __future__ import annotations

from pyspark.sql import functions as F

from vigora.operators import metadata as M
from vigora.operators import render as R
from vigora.operators import structure as S

CELLS = "slug string, csv string, row_no int, header array<string>, cells array<string>"
METAS = "slug string, identificador string, tipo string, numero string, ano string, ementa string, fonte_arquivo string, sha256_16 string, revisao string, titulo string, correlacao_ifrs string"
LAW = "LIVRO I\nArt. 5º Velho texto\nArt. 5º Novo texto, conforme o art. 10 e o art. 2º:\nI – um;\n§ 1º Dois (Redação dada pela Lei nº 1)\nTÍTULO II\nArt. 10 Fim."
ITEMS = "OBJETIVO\n1. Velho\n1. Novo, ver item 2 (Nova redação dada pela R1)\n(a) letra\n(ii) romano\nAPÊNDICE A – Exemplos\nA1. Exemplo\nVAZIA"


def lines(spark, doc, text):
    return S.numbered_lines(spark.createDataFrame([(doc, text)], "doc_id string, text string"))


def metas(spark):
    rows = [
        ("lei-1-2020", "Lei 1/2020", "Lei", "1", "2020", "Dispõe sobre \"tudo\".", "lei.pdf", "abc", None, None, None),
        ("cpc-20-r1", "CPC 20 (R1)", "CPC", "20", None, None, "cpc.pdf", "def", "R1", "Custos", "IAS 23"),
    ]
    return spark.createDataFrame(rows, METAS)


def annexes(spark):
    rows = [("lei-1-2020", "anexo_01.csv", i, ["Item", "NCM"], [str(i), "x"]) for i in range(1, 9)] + [("lei-1-2020", "anexo_02.csv", 1, ["A", "B"], ["só uma"])]
    return spark.createDataFrame(rows, CELLS)


def whole(rows):
    return "\n".join(r["markdown"] for r in sorted(rows, key=lambda r: (r["part"], r["place"])))


def test_law_records(spark):
    units = S.law_units(lines(spark, "lei-1-2020", LAW))
    got = {r["id"]: r for r in R.law_records(units, metas(spark), annexes(spark)).collect()}
    assert set(got) == {"lei-1-2020--art-5--anterior-001", "lei-1-2020--art-5", "lei-1-2020--art-10"}
    r = got["lei-1-2020--art-5"]
    assert (r["norma"], r["tipo"], r["path"], r["artigo"], r["vigente"], r["fonte"]) == ("Lei 1/2020", "Lei", "LIVRO I > Art. 5º", "5", True, "lei.pdf")
    assert r["texto"] == "Art. 5º. Novo texto, conforme o art. 10 e o art. 2º:\nI – um;\n§ 1º Dois (Redação dada pela Lei nº 1)"
    assert (r["notas_vigencia"], r["refs"], r["anexos"]) == (["(Redação dada pela Lei nº 1)"], ["art-10", "art-2"], ["anexo_01.csv", "anexo_02.csv"])
    assert got["lei-1-2020--art-10"]["path"] == "LIVRO I > TÍTULO II > Art. 10" and not got["lei-1-2020--art-5--anterior-001"]["vigente"]
    unknown = R.law_records(units.withColumn("doc_id", F.lit("z")), metas(spark), annexes(spark)).first()
    assert unknown["norma"] is None and unknown["anexos"] == []


def test_law_document(spark):
    units = S.law_units(lines(spark, "lei-1-2020", LAW))
    got = whole(R.document_rows(metas(spark).where("tipo = 'Lei'"), R.unit_markdown(units), annexes(spark)).collect())
    assert got == (
        '---\nidentificador: "Lei 1/2020"\ntipo: "Lei"\nnumero: "1"\nano: "2020"\nfonte_arquivo: "lei.pdf"\nsha256_16: "abc"\nementa: "Dispõe sobre \\"tudo\\"."\n---\n\n# Lei 1/2020\n\n> Dispõe sobre "tudo".\n\n'
        "## Anexos e tabelas\n\n- **Anexo 01** (8 linhas) → `anexos/anexo_01.csv`  \n  Colunas: Item, NCM\n"
        '\n## LIVRO I\n\n<a id="art-5--anterior-001"></a>\n> _(Art. 5º — redação anterior, superada)_  \n> Velho texto\n'
        '\n<a id="art-5"></a>\n**Art. 5º.** Novo texto, conforme o art. 10 e o art. 2º:\n  - I – um;\n\n**§ 1º** Dois (Redação dada pela Lei nº 1)\n'
        '\n### TÍTULO II\n\n<a id="art-10"></a>\n**Art. 10.** Fim.\n'
        "\n> Tabela:\n\n| A | B |\n| --- | --- |\n| só uma |  |"
    )


def test_accounting_records_counts_and_document(spark):
    known = spark.createDataFrame([], "name string")
    told = lines(spark, "cpc-20-r1", ITEMS)
    units = S.accounting_units(told, known)
    got = {r["id"]: r for r in R.accounting_records(units, metas(spark), annexes(spark)).collect()}
    assert set(got) == {"cpc-20-r1--item-1--anterior-001", "cpc-20-r1--item-1", "cpc-20-r1--item-a1"}
    r = got["cpc-20-r1--item-1"]
    assert (r["norma"], r["numero_norma"], r["revisao"], r["correlacao_ifrs"], r["path"], r["refs"]) == ("CPC 20 (R1)", "20", "R1", "IAS 23", "OBJETIVO > Item 1", ["item-2"])
    assert r["texto"] == "Item 1. Novo, ver item 2 (Nova redação dada pela R1)\n(a) letra\n(ii) romano"
    assert (got["cpc-20-r1--item-a1"]["apendice"], got["cpc-20-r1--item-a1"]["secao"]) == ("A", "APÊNDICE A – Exemplos")
    c = S.accounting_counts(units, S.accounting_sections(told, known)).first().asDict()
    assert c == {
        "doc_id": "cpc-20-r1", "n_itens": 3, "n_itens_vigentes": 2, "n_itens_apendice": 1, "n_redacoes_anteriores": 1, "n_alineas": 1, "n_secoes": 3,
        "secoes": ["OBJETIVO", "APÊNDICE A – Exemplos", "VAZIA"],
    }
    text = whole(R.document_rows(metas(spark).where("tipo = 'CPC'"), R.items_markdown(units), annexes(spark), R.ACCOUNTING_KEYS).collect())
    assert "# CPC 20 (R1) — Custos\n\n> **Correlação:** IAS 23\n" in text
    assert '\n## OBJETIVO\n\n\n<a id="item-1--anterior-001"></a>\n> _(Item 1 — redação anterior, superada por revisão)_  \n> Velho\n\n<a id="item-1"></a>\n**1.** Novo, ver item 2 (Nova redação dada pela R1)\n  - **(a)** letra\n    - **(ii)** romano' in text


def test_meta_records(spark):
    pages = spark.createDataFrame([("d", 1, "a"), ("d", 2, None)], "doc_id string, page_no int, text string")
    heads = spark.createDataFrame([("d", "LEI COMPLEMENTAR Nº 1.234, DE 5 DE MAIO DE 2024\n\nDispõe sobre o que é preciso\ndispor, e mais nada.\nArt. 1º")], "doc_id string, text string")
    m = R.law_meta(pages, heads, S.law_units(lines(spark, "d", LAW)), annexes(spark)).first()
    assert (m["identificador"], m["ementa"], m["n_artigos"], m["n_artigos_vigentes"], m["n_redacoes_anteriores"], m["n_anexos_csv"], m["n_paginas"]) == (
        "LC 1234/2024", "Dispõe sobre o que é preciso dispor, e mais nada.", 3, 2, 1, 0, 2)


def test_accounting_heads(spark):
    texts = [
        "PRONUNCIAMENTO TÉCNICO cpc 26 (R1)\nAPRESENTAÇÃO DAS DEMONSTRAÇÕES QUE SÃO CONTÁBEIS\nCorrelação às Normas Internacionais de Contabilidade –\nIAS 1", "texto que cita o CPC 9 e a IAS 7",
        "NBC TG 1002 – CONTABILIDADE PARA MICRO, SOB REGIME\nAprova a NBC TG 1002, que dispõe sobre micro.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    h = M.accounting_header(F.col("t"))
    rows = df.select("i", h.alias("h"), M.ifrs(F.col("t")).alias("ifrs"), M.title(F.col("t")).alias("title"), M.accounting_slugs(h).alias("s")).orderBy("i").collect()
    assert tuple(rows[0]["h"]) == ("CPC", "26", "R1") and rows[0]["ifrs"] == "IAS 1" and rows[0]["title"] == "Apresentação das Demonstrações que São Contábeis"
    assert tuple(rows[0]["s"]) == ("cpc-26", "cpc-26-r1")
    assert rows[1]["h"] is None and rows[1]["ifrs"] is None and rows[1]["title"] is None
    assert tuple(rows[2]["h"]) == ("NBC TG", "1002", "Original") and rows[2]["title"] == "Contabilidade para Micro, sob Regime"
