from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from vigora.operators import dialect as D
from vigora.operators import lines as L


def one(spark, text, how):
    return spark.createDataFrame([(text,)], "text string").select(how(F.col("text"))).first()[0]


def many(spark, texts, how):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", how(F.col("text")).alias("t"))
    return [r["t"] for r in df.orderBy("i").collect()]


def test_lines_end_at_any_break(spark):
    assert one(spark, "a\r\nb\rc\x0bd\u2028e\n", L.split_lines) == ["a", "b", "c", "d", "e"]
    assert one(spark, "", L.split_lines) == [] and one(spark, None, L.split_lines) is None


def test_repeated_lines(spark):
    pages = [("d", 1, "HEAD\nbody a\nfoot 1"), ("d", 2, "HEAD\nx\ny\nz\nbody b\nw\nfoot 2"), ("e", 1, "one\ntwo\nxx"), ("f", 1, None), (None, 1, "q\nq")]
    got = {(r[0], r[1]): r[2] for r in L.repeated_lines(spark.createDataFrame(pages, "doc_id string, page_no int, text string")).collect()}
    # a page of three lines counts each twice, as its bands overlap
    assert got == {("d", "HEAD"): 3, ("d", "body a"): 2, ("d", "foot 1"): 2, ("e", "one"): 2, ("e", "two"): 2}


def test_a_line_on_one_of_two_long_pages_stays(spark):
    pages = [("d", n, "\n".join(f"line {n} {i}" for i in range(9))) for n in (1, 2)]
    assert L.repeated_lines(spark.createDataFrame(pages, "doc_id string, page_no int, text string")).collect() == []


def test_hyphens(spark):
    assert one(spark, "contri-\nbuição é x -\ny", L.dehyphenate) == "contribuição é x -\ny"


START = re.compile(r"\s*(LIVRO|TÍTULO|Art\.?\s*\d|§\s*\d|[IVXLCDM]{1,6}\s*[-–—]\s|[a-z]\)\s)", re.I)


def fold_paragraphs(text):
    out = []
    for line in text.split("\n"):
        s = line.strip()
        if s and out and out[-1] and out[-1][-1] not in ".:;" and not START.match(s):
            out[-1] += " " + s
        else:
            out.append(s)
    return "\n".join(out)


def test_paragraphs_against_a_fold(spark):
    rng = random.Random(1)
    bits = ["", "  ", "word and", "Ends.", "Art. 3 x", "§ 1º y", "II - z", "a) b", "more;", "TÍTULO I", "tail: "]
    texts = ["\n".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    assert many(spark, texts, lambda c: L.rejoin(c, D.LAW)) == [fold_paragraphs(t) for t in texts]


NUMBER = re.compile(r"(\d+[A-Z]?\.|\d+(\.\d+)+[A-Z]?|[A-Z]\.?\d+(\.\d+)*[A-Z]?\.?)$")


def fold_orphans(text):
    todo, out = text.split("\n"), []
    while todo:
        line = todo.pop(0)
        if len(line.strip()) <= 12 and NUMBER.match(line.strip()) and any(x.strip() for x in todo):
            while not todo[0].strip():
                todo.pop(0)
            out.append(f"{line.strip()} {todo.pop(0).strip()}")
        else:
            out.append(line)
    return "\n".join(out)


def test_orphan_numbers_against_a_fold(spark):
    rng = random.Random(2)
    bits = ["", "", "1.", "2.4", "B1.", "12A.", "1234567890123.", "text", " padded ", "3. full"]
    texts = ["\n".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    assert many(spark, texts, L.merge_orphans) == [fold_orphans(t) for t in texts]


def test_titles(spark):
    text = "FLUXOS DE CAIXA DE\nINVESTIMENTO\ntext\nM O D E L O S\nx\nÚNICO\n\nOUTRO."
    assert one(spark, text, lambda c: L.merge_titles(L.split_lines(c))) == "FLUXOS DE CAIXA DE INVESTIMENTO\ntext\nMODELOS\nx\nÚNICO\n\nOUTRO."


def test_capitals_of_any_length(spark):
    """A line in capitals, joined from many titles or spaced or long by itself, is read without a stack that grows with it."""
    title, spaced = "FLUXOS DE CAIXA - PARTE", "A " * 9_000 + "B"
    ends = [f"({c}) x." for c in "abcdef"]
    pages = [(doc, 1, "\n".join([*ends[:3], *middle, *ends[3:]])) for doc, middle in (("d", [title] * 900), ("e", [spaced]), ("f", [spaced + "b"]))]
    got = whole(L.clean_lines(spark.createDataFrame(pages, "doc_id string, page_no int, text string"), D.ACCOUNTING).collect())
    read = {"d": " ".join([title] * 900), "e": "A" * 9_000 + "B", "f": spaced + "b"}
    assert got == {doc: "\n".join([*ends[:3], line, *ends[3:]]) for doc, line in read.items()}


def test_tidy_noise_and_recognition(spark):
    assert one(spark, "  a \t b\n\n\n\nc  ", L.tidy) == "a b\n\nc"
    noise = lambda c: F.transform(F.split(c, r"\|"), lambda x: L.is_noise(x, D.LAW_NOISE))
    assert one(spark, "Página 3 de 9|fls. 12|17|Diário Oficial da União|www.x.br|12345|texto", noise) == [True] * 5 + [False] * 2
    assert one(spark, " short ", L.needs_ocr) is True
    pick = lambda mode: lambda c: L.choose_text(c, F.lit("longer text"), mode)
    assert [one(spark, "x", pick(m)) for m in ("auto", "force", "off")] == ["longer text", "longer text", "x"]
    assert one(spark, None, pick("auto")) == "longer text"


def whole(rows):
    """Texts of documents from their rows of lines."""
    out = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["line_no"])):
        out.setdefault(r["doc_id"], []).append(r["line"])
    return {d: "\n".join(ls) for d, ls in out.items()}


def test_whole_cleaning_joins_pages_in_order(spark):
    schema = "doc_id string, page_no int, text string"
    pages = [("d", 2, "DIÁRIO\nda lei.\n7"), ("d", 1, "DIÁRIO\nArt. 1º O dis-\nposto\n8"), ("e", 1, None), (None, 1, "texto")]
    # short pages: their bands overlap, so all their lines count as repeated; the quirk is kept
    assert whole(L.clean_lines(spark.createDataFrame(pages, schema)).collect()) == {}
    long = [("d", n, "HEAD\n" + "\n".join(f"parte {n} {i}" for i in range(8)) + f"\n{n}") for n in (1, 2)]
    got = whole(L.clean_lines(spark.createDataFrame(long, schema)).collect())
    assert got["d"] == " ".join(f"parte {n} {i}" for n in (1, 2) for i in range(8))


def test_rows_of_lines_against_whole_texts(spark):
    """Cleaning over rows equals the same steps on the text of each document."""
    rng = random.Random(4)
    bits = ["", "", "  ", "1.", "2.4", "B1.", "word and", " padded end-", "on it", "Ends.", "Art. 3 x", "§ 1º y", "a) b", "more;", "FLUXOS DE", "CAIXA - B", "M O D E L O S", "tail: ", "x\t  y"]
    texts = ["\n".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    filler = "\n".join(f"corpo da página {k}." for k in range(8))
    rows = [(i, 2 * n + 1, part) for i, t in enumerate(texts) for n, part in enumerate((t[: len(t) // 2], t[len(t) // 2 :], filler))]
    pages = spark.createDataFrame(rows, "doc_id int, page_no int, text string").repartition(3)
    for how in (D.LAW, D.ACCOUNTING):
        got = whole(L.clean_lines(pages, how).collect())
        kept = {}
        for r in L.kept_lines(pages, how).collect():
            kept.setdefault(r["doc_id"], {})[r["page_no"]] = r["lines"]
        joined = ["\n".join(x for _, ls in sorted(kept[i].items()) for x in ls) for i in range(len(texts))]

        def steps(c, how=how):
            c = L.dehyphenate(c)
            if how.orphans:
                c = L.merge_titles(F.split(L.merge_orphans(c), "\n", -1))
            return L.tidy(L.rejoin(c, how))

        want = {i: t for i, t in enumerate(many(spark, joined, steps)) if t}
        assert got == want
