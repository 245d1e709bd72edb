from __future__ import annotations

import math
import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute  # noqa: F401

from vigora.llm import stuffing as S
from vigora.llm.packing import spread

SENTENCES = [
    "A entidade deve reconhecer a receita quando o controle do bem passa ao cliente, conforme o contrato assinado entre as partes.",
    "O contribuinte poderá compensar o crédito apurado no período com débitos próprios, desde que mantida a escrituração.",
    "Nos termos da lei, o imposto incide sobre a operação de venda e sobre a importação de bens por pessoa jurídica.",
    "O prazo para entrega da declaração termina no último dia útil do mês seguinte ao da ocorrência do fato gerador.",
    "A fiscalização examinará os livros e os documentos que deram origem ao lançamento contestado pelo interessado.",
]


def corpus(rng, n=60):
    nouns = ["multa", "receita", "nota", "quota", "base", "taxa", "renda", "folha"]
    pages = {}
    for i in range(n):
        pages[i] = " ".join(rng.choice(SENTENCES).replace("receita", rng.choice(nouns)) for _ in range(12))
    return pages


SPAM = {
    900: "contador barato simples nacional tabela " * 40,
    901: ", ".join(random.Random(1).choice(["contador barato em Tica", "holding familiar preço Lodo", "consulta ncm grátis Praia", "abrir empresa online Bana"]) for _ in range(60)),
    902: "\n".join(f"www.x{i}.example/abc" for i in range(30)),
    903: "#contadorbarato #abrir_empresa2025 " * 20,
    904: "".join(f'<li><a href="//a{i}.example/b">contador barato</a></li>' for i in range(20)),
    905: "Nosso advogado tributarista faz advogado tributarista para quem quer advogado tributarista em Tica! " * 15,
    906: "c o n t a d o r   b a r a t o, v@l0r d@ n0t@, " * 20,
}
HONEST = {
    800: "\n".join(f"Art. {i}º Das penalidades ........ {i * 3}" for i in range(1, 40)),
    801: "Ficam revogados:\n" + "\n".join(f"{r} – o art. {i} da Lei nº 63.12{i}, de 3 de agosto de 2004;" for i, r in enumerate(["I", "II", "III", "IV", "V", "VI", "VII"])),
    802: " ".join(SENTENCES) + "\nTags: contador barato, contador barato, abrir empresa online, contador barato",
    803: " ".join(f"{s[:-1]}, como se lê em [nota {i}](https://x.example/{i})." for i, s in enumerate(SENTENCES)),
    804: "\n".join(f"{i}. Resinas plásticas, sem movimento no período – 8594.{i} – 4% ao ano" for i in range(1, 30)),
    805: "\n".join(f"{i}ª faixa | de R$ {i}.000,00 a R$ {i}.999,00 | {i},5%" for i in range(1, 20)),
}


def test_spam_and_content(spark):
    pages = corpus(random.Random(2), 400) | SPAM | HONEST
    rows = [(i, t, "x") for i, t in pages.items()] + [(700, None, "x"), (701, "", "x"), (702, " \n ", "x"), (703, "www.a.example", "x"), (None, SPAM[902], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words string")
    for buckets in (1, 7):
        got = {r["doc_id"]: r for r in S.spam_pages(df, buckets).collect()}
        assert {i for i, r in got.items() if r["spam"]} == set(SPAM), {i: (r["share"], r["mean_pmi"]) for i, r in got.items() if i >= 800}


def test_copies_and_shared_phrases_do_not_hide_spam(spark):
    pages = corpus(random.Random(4), 400)
    stuffed = SPAM[905]
    copies = {1000 + i: stuffed for i in range(200)}
    alike = {2000 + i: stuffed.replace("Tica", f"Vila {'abcdefghij'[i % 10] * (2 + i // 10)}") for i in range(200)}
    for spam in (copies, alike):
        df = spark.createDataFrame(list((pages | spam | HONEST).items()), "doc_id bigint, text string")
        for buckets in (1, 7):
            assert {r["doc_id"] for r in S.spam_pages(df, buckets).where("spam").collect()} == set(spam)


def test_word_salad_has_no_mutual_information(spark):
    rng = random.Random(3)
    pages = corpus(rng)
    words = " ".join(pages.values()).replace(",", "").replace(".", "").split()
    salad = lambda of: ". ".join(" ".join(rng.choice(of) for _ in range(20)) for _ in range(12)) + "."
    by_frequency = {500 + i: salad(words) for i in range(3)}
    by_vocabulary = {600 + i: salad(sorted(set(words))) for i in range(3)}
    unknown = {700: salad([f"palavra{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}" for i in range(64)])}
    df = spark.createDataFrame(list((pages | by_frequency | by_vocabulary | unknown).items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in S.spam_pages(df, 3).collect()}
    assert {i for i, r in got.items() if r["spam"]} == by_frequency.keys() | by_vocabulary.keys()
    assert max(got[i]["mean_pmi"] for i in by_frequency.keys() | by_vocabulary.keys()) < S.SALAD_PMI < min(got[i]["mean_pmi"] for i in pages) - 1
    assert got[700]["mean_pmi"] is None  # words that no other page has say nothing


def test_counts_are_those_of_the_whole_corpus(spark):
    texts = {1: "um dois três. um dois", 2: "um dois", 3: "dois três um", 4: "três quatro", 5: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    pairs = {i: Counter(p for s in t.split(". ") for p in zip(s.split(), s.split()[1:], strict=False)) for i, t in texts.items()}
    both = sum(pairs.values(), Counter())
    ends = sum((Counter([w for p, n in c.items() for w in p * n]) for c in pairs.values()), Counter())
    on = Counter(w for c in pairs.values() for w in {w for p in c for w in p})
    total = sum(both.values())
    for buckets, parts in ((1, 1), (5, 3)):
        rows = {r["doc_id"]: r for r in S.page_scores(df.repartition(parts), buckets).collect()}
        assert {i: (r["words"], r["pairs"]) for i, r in rows.items()} == {1: (5, 3), 2: (2, 1), 3: (3, 2), 4: (2, 1)}
        for i, r in rows.items():
            known = {p: n for p, n in pairs[i].items() if min(on[p[0]], on[p[1]]) >= 3}
            assert r["informative"] == sum(known.values())
            want = [n * math.log((both[x, y] - n + 1) / (ends[x] * ends[y] / (4 * total) + 1)) for (x, y), n in known.items()]
            assert abs(r["pmi"] * max(sum(known.values()), 1) - sum(want)) < 1e-9


def packed_bytes(texts, buckets):
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    batches = list(S._pack(buckets, 0.06)(iter([rows])))
    sent = pa.Table.from_batches(batches)
    assert all(len(p) > 16 for p in sent["payload"].to_pylist())
    keys = sent.filter(pa.compute.greater_equal(sent["bucket"], 0))
    back = sum(sum(map(len, S._count(keys.filter(pa.compute.equal(keys["bucket"], b)))["payload"].to_pylist())) for b in set(keys["bucket"].to_pylist()))
    return sum(map(len, sent["payload"].to_pylist())) + back


def test_bytes_do_not_grow_with_buckets():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4_000)]
    texts = [" ".join(rng.choice(words) for _ in range(100)) + "." for _ in range(2_000)]
    few, many = packed_bytes(texts, 12), packed_bytes(texts, 1_200)
    assert many < 1.5 * few, (few, many)


def test_a_pair_on_every_page_is_one_entry_of_a_batch():
    texts = [f"contador barato {'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(5_000)]
    sent = pa.Table.from_batches(list(S._pack(1, 0.06)(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(5_000)), "text": texts})]))))
    keys, times, *_ = spread(sent.filter(pa.compute.equal(sent["bucket"], 0))["payload"][0].as_py())
    assert len(keys) == 10_003 and sorted(times.tolist())[-3:] == [5_000, 5_000, 10_000]


def test_links_and_tags_count_by_the_corpus(spark):
    """A list of links is spam because links follow links far more often than elsewhere, not because it has links."""
    pages = corpus(random.Random(7), 200)
    links = "\n".join(f"https://casa{i}.example/pagina" for i in range(20))
    few = {i: t + "\n" + "\n".join(f"https://casa{k}.example/x" for k in range(4)) for i, t in pages.items() if i < 100}
    df = lambda rows: spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    spam = lambda rows, **how: {r["doc_id"] for r in S.spam_pages(df(rows), 3, **how).where("spam").collect()}
    assert spam(pages | few | {900: links}) == {900}
    scores = {r["doc_id"]: r for r in S.page_scores(df(pages | few | {900: links}), 3, link_excess=1e9).collect()}
    assert scores[900]["stuffed"] == 0 and scores[900]["words"] == 100  # without an excess over the corpus nothing is stuffed


def test_empty_and_long(spark):
    schema = "doc_id bigint, text string"
    assert S.spam_pages(spark.createDataFrame([], schema), 3).collect() == []
    df = spark.createDataFrame([(1, "contador barato agora " * 60_000)], schema)
    assert S.spam_pages(df, 3).first()["spam"]
