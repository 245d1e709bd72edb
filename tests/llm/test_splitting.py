from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from vigora.llm import splitting as P

TEXT = st.lists(st.sampled_from(["palavra", "a", ".", ";\n", "\n\n", " ", "  \t", "§ 1º ", "II - x", "Fim. ", "\xa0", "x" * 40]), max_size=120).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(20, 90), st.integers(0, 15))
def test_pieces_fit_overlap_and_join_to_the_text(text, limit, overlap):
    whole, paragraphs = P.measured(text)
    assert len(whole) == len(re.sub(f"[{P.SPACE}]+", " ", text).strip(P.SPACE))
    done, back = 0, ""
    for start, end, _ in P.cuts(whole, paragraphs, limit, overlap):
        assert 0 < end - start <= limit and start <= done and done - start <= overlap and end > done
        back += whole[done:end]
        done = end
    assert back == whole


def test_cuts_at_the_strongest_boundary():
    text = "A" * 30 + ".\n\n" + "B" * 10 + ". " + "C" * 40
    whole, paragraphs = P.measured(text)
    assert [k for *_, k in P.cuts(whole, paragraphs, 50, 5)] == ["paragraph", "sentence", "end"] or P.cuts(whole, paragraphs, 50, 5)[0][2] == "paragraph"
    listed = "Caput:\n" + "I - um " + "x" * 30 + ";\n" + "II - dois " + "y" * 30
    assert P.cuts(*P.measured(listed), 60, 0)[0][2] == "item"
    assert {k for *_, k in P.cuts("x" * 1000, [], 100, 10)} == {"hard", "end"}


def test_early_sentence_goes_before_a_word():
    text = "Curta frase. " + "palavra " * 11 + "fim. " + "Outra frase. " * 3
    whole, paragraphs = P.measured(text)
    got = P.cuts(whole, paragraphs, 100, 5)
    assert "word" not in {k for *_, k in got} and got[0] == (0, 13, "sentence")


def test_table(spark):
    rows = [("a", None, 1), ("b", "", 1), ("c", "  \n ", 1), ("d", "x " * 1500, 1), ("d", "x " * 1500, 1), ("e", "y" + " " * 5000, 1), (None, "z" * 2401, 1)]
    df = spark.createDataFrame(rows, "id string, texto string, piece string")
    got = P.oversized(df.drop("piece"), "id", "texto").collect()
    assert sorted({str(r["id"]) for r in got}) == ["None", "d"]
    assert all(len(r["piece"]) <= 2400 and r["overlap"] <= 200 for r in got)
    assert {r["id"] for r in P.split_texts(df, "id", "texto").collect()} == {"d", "e", None}
    assert P.oversized(df.limit(0), "id", "texto").collect() == []
