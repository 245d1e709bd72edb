"""Metadata of a document from its first lines: type, number, year, summary, title, slug."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigora.operators import dialect as D
from vigora.operators.lines import ci, split_lines, strip

# The line that declares a norm, verbs that open a summary, lines of navigation.
EPIGRAPH = (
    rf"^{D.S}*(LEI COMPLEMENTAR|EMENDA CONSTITUCIONAL|MEDIDA PROVIS[ÓO]RIA|INSTRU[ÇC][ÃA]O NORMATIVA|ATO CONJUNTO"
    rf"|ATO DECLARAT[ÓO]RIO|DECRETO-LEI|DECRETO|LEI|PORTARIA|RESOLU[ÇC][ÃA]O)(?:{D.S}+[\p{{L}}\p{{N}}_/]+)*"
    rf"{D.S}+N[º°o]?\.?{D.S}*([\d.]+){D.S}*,?{D.S}*DE{D.S}+(?:.*?[^\p{{L}}\p{{N}}_])?((?:19|20)\d{{2}})(?:[^\p{{L}}\p{{N}}_]|$)"
)
SUMMARY = (
    r"^(?:Institui|Disp[õo]e|Altera|Regulamenta|Estabelece|Cria|Aprova|Define|Reduz|Concede|Autoriza|Fixa|Revoga|Acresce|Consolida)"
)
SUMMARY_END = r"^(?:RESOLVEM|O PRESIDENTE|O SECRET[ÁA]RIO)"
NAVIGATION = (
    r"^(?:Presid[êe]ncia|Casa Civil|Secretaria|Subchefia|Mensagem de veto|Produ[çc][ãa]o de efeitos|Texto compilado|Vig[êe]ncia"
    r"|\(Promulga[çc][ãa]o|\(Vide|LEI COMPLEMENTAR|LEI |DECRETO|MEDIDA PROVIS|ATO CONJUNTO|ATO DECLARAT|DI[ÁA]RIO OFICIAL"
    r"|Publicado em:|[ÓO]rg[ãa]o:|Minist[ée]rio)"
)
NUMBER = rf"(?:n[º°o]?\.?){D.S}*(\d[\d.]*)"
YEAR = r"(?:^|[^\p{L}\p{N}_])((?:19|20)\d{2})(?:[^\p{L}\p{N}_]|$)"
# Header of an accounting norm (number, revision), its correlation with an international standard,
# lines that are no title, words that stay in lower case.
CPC_START = rf"(?iu)PRONUNCIAMENTO{D.S}+T[ÉE]CNICO{D.S}+CPC{D.S}+(\d+)(?:{D.S}*\(R(\d+)\))?"
NBC_START = rf"(?iu)NBC{D.S}+TG{D.S}+(\d+)(?:{D.S}*\(R(\d+)\))?"
CORRELATION = rf"(?iu)Correla[çc][ãa]o{D.S}+[àa]s?{D.S}+Normas[\s\S]*?(IAS|IFRS|IFRIC|SIC){D.S}+(\d+)"
TITLE_BLOCK = (
    r"^(?:Correla|IFRS|IAS|COMIT|Este material|Termos|Os pronunc|Pronunciamentos|República|Federativa|Notice|Reproduced|CPC/CPC|Committee"
    r"|Support|Foundation|Accounting|Pronounc|\* |de outras partes|deverá ser|são emitidos|não devem ser|não foram|contém material"
    r"|in respect|This material|Todos esses|organismo)"
)
SMALL_WORDS = (
    "a", "à", "as", "às", "ao", "aos", "com", "da", "das", "de", "do", "dos", "e", "em", "na", "nas", "no", "nos", "o", "os", "ou",
    "para", "por", "que", "sem", "sob", "sobre",
)

#: Letters that lose their marks in a slug: every precomposed Latin letter that decomposes to ASCII.
ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x250)) if len(d := unicodedata.normalize("NFKD", c)) > 1 and d[0].isascii() and d[1:].encode("ascii", "ignore") == b"")
PLAIN = "".join(unicodedata.normalize("NFKD", c)[0] for c in ACCENTED)


def first_match(items: Column, test: object, pick: object) -> Column:
    """``pick`` of the first element for which ``test`` holds, else null."""
    hits = F.filter(items, test)
    return F.when(F.size(hits) > 0, pick(F.get(hits, F.lit(0))))


def epigraph(text: Column, first: int = 60) -> Column:
    """``(tipo, numero, ano)`` of the first declaring line among the first lines; an unaccented spelling has no type."""
    rx = f"(?iu){EPIGRAPH}"
    lines = F.transform(F.slice(split_lines(text), 1, first), strip)
    types = F.create_map(*[F.lit(x) for pair in D.TYPES for x in pair])

    def pick(line: Column) -> Column:
        return F.struct(
            F.try_element_at(types, F.upper(F.regexp_extract(line, rx, 1))).alias("tipo"),
            F.replace(F.regexp_extract(line, rx, 2), F.lit("."), F.lit("")).alias("numero"),
            F.regexp_extract(line, rx, 3).alias("ano"),
        )

    return first_match(lines, lambda x: x.rlike(rx), pick)


def fallback(text: Column) -> Column:
    """``(tipo, numero, ano)`` from the first 15 lines: the first type of the list that they contain, number, year."""
    head = F.upper(F.array_join(F.slice(split_lines(text), 1, 15), "\n"))
    tipo = F.coalesce(*[F.when(F.contains(head, F.lit(k)), F.lit(v)) for k, v in D.TYPES])
    none = lambda c: F.when(c != "", c)
    return F.struct(
        tipo.alias("tipo"),
        none(F.replace(F.regexp_extract(head, f"(?iu){NUMBER}", 1), F.lit("."), F.lit(""))).alias("numero"),
        none(F.regexp_extract(F.substring(text, 1, 1200), YEAR, 1)).alias("ano"),
    )


def identity(text: Column) -> Column:
    """Type, number and year: the declaring line, and what it lacks from the head of the text."""
    e, f = epigraph(text), fallback(text)
    use = e["tipo"].isNotNull()
    return F.struct(
        F.coalesce(e["tipo"], f["tipo"]).alias("tipo"),
        F.when(use, e["numero"]).otherwise(F.coalesce(e["numero"], f["numero"])).alias("numero"),
        F.when(use, e["ano"]).otherwise(F.coalesce(e["ano"], f["ano"])).alias("ano"),
    )


def norm_id(tipo: Column, numero: Column, ano: Column, other: Column) -> Column:
    full = F.concat(tipo, F.lit(" "), numero, F.when(ano.isNotNull() & (ano != ""), F.concat(F.lit("/"), ano)).otherwise(""))
    return F.when((tipo != "") & (numero != ""), full).otherwise(other)


def stated_summary(text: Column) -> Column:
    """The line that opens with a typical verb and up to 14 lines that follow, to a full stop, blank or structural line."""

    def whole(lines: Column) -> Column:
        opens = lambda x: ci(x, SUMMARY) & (F.length(x) > 20)
        at = F.array_position(F.transform(lines, opens), True)
        tail = F.slice(lines, (at + 1).cast("int"), F.lit(14))
        stop = lambda x: (x == "") | ci(x, SUMMARY_END) | ci(x, NAVIGATION) | ci(x, D.LAW_START)

        def joined(rest: Column) -> Column:
            last = lambda marks, before: F.coalesce(F.nullif(F.array_position(marks, True), F.lit(0)) - before, F.size(rest).cast("bigint"))
            n = F.least(last(F.transform(rest, stop), 1), last(F.transform(rest, lambda x: x.endswith(".")), 0)).cast("int")
            return F.array_join(F.concat(F.slice(lines, at.cast("int"), F.lit(1)), F.slice(rest, F.lit(1), n)), " ")

        return F.when(at > 0, F.get(F.transform(F.array(tail), joined), F.lit(0)))

    return F.get(F.transform(F.array(F.transform(split_lines(text), strip)), whole), F.lit(0))


def summary(text: Column, head: Column | None = None) -> Column:
    """Summary stated in the raw head of a document, else in its text, else the text's first long plain line."""
    lines = F.transform(split_lines(text), strip)
    plain = first_match(lines, lambda x: (F.length(x) > 60) & ~ci(x, NAVIGATION) & ~ci(x, D.LAW_START) & ~((F.upper(x) == x) & (F.lower(x) != x)), lambda x: x)
    return F.coalesce(*([stated_summary(head)] if head is not None else []), stated_summary(text), plain)


def slug(value: Column, default: str = "norma") -> Column:
    """Lower-case ASCII words joined by hyphens; ``/`` counts as a hyphen; ordinal marks become letters."""
    plain = F.translate(F.translate(value, ACCENTED, PLAIN), "ºª", "oa")
    kept = F.regexp_replace(F.regexp_replace(plain, "/", "-"), r"[^A-Za-z0-9_\t-\r \-]", "")
    joined = F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(kept, r"^[\t-\r ]+", ""), r"[\t-\r ]+$", "")), r"[\t-\r _]+", "-")
    return F.when(joined == "", F.lit(default)).otherwise(joined)


def slug_exact(df: DataFrame, column: str, out: str, default: str = "norma") -> DataFrame:
    """As ``slug`` for any script: full compatibility decomposition, in Arrow batches."""
    import re

    def one(v: str | None) -> str | None:
        if v is None:
            return None
        v = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().replace("/", "-")
        return re.sub(r"[\s_]+", "-", re.sub(r"[^\w\s-]", "", v).strip().lower()) or default

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([one(v) for v in b.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{out}` string")


def accounting_header(text: Column) -> Column:
    """``(tipo, numero, revisao)`` of an accounting norm, ``R2`` or ``Original``: a pronouncement's header, else an NBC TG's; null without either."""
    def told(tipo: str, rx: str) -> Column:
        r = F.regexp_extract(text, rx, 2)
        revision = F.when(r != "", F.concat(F.lit("R"), r)).otherwise("Original")
        return F.when(text.rlike(rx), F.struct(F.lit(tipo).alias("tipo"), F.regexp_extract(text, rx, 1).alias("numero"), revision.alias("revisao")))

    return F.coalesce(told("CPC", CPC_START), told("NBC TG", NBC_START))


def accounting_id(header: Column) -> Column:
    """``CPC 20 (R1)``: type, number and, of a revised norm, its revision."""
    revision = F.when(header["revisao"] != "Original", F.concat(F.lit(" ("), header["revisao"], F.lit(")"))).otherwise("")
    return F.concat(header["tipo"], F.lit(" "), header["numero"], revision)


def accounting_slugs(header: Column) -> Column:
    """``(dir_slug, id_slug)``: a norm's folder does not name its revision, the ids of its units do."""
    folder = slug(F.concat(header["tipo"], F.lit(" "), header["numero"]), "cpc")
    return F.struct(folder.alias("dir_slug"), slug(accounting_id(header), "cpc").alias("id_slug"))


def ifrs(text: Column) -> Column:
    """The first international standard behind ``Correlação às Normas``, within the first 2,000 characters."""
    head = F.substring(text, 1, 2000)
    found = F.concat(F.upper(F.regexp_extract(head, CORRELATION, 1)), F.lit(" "), F.regexp_extract(head, CORRELATION, 2))
    return F.when(head.rlike(CORRELATION), found)


def nbc_title(text: Column) -> Column:
    """Title in capitals behind ``NBC TG n –``, n being the number of the first ``NBC TG`` of the text."""
    rx = F.concat(F.lit(f"NBC{D.S}+TG{D.S}+"), F.regexp_extract(text, NBC_START, 1), F.lit(rf"{D.S}*[–\-—]{D.S}*([{D.CAPS}][{D.CAPS} ,]{{5,100}})"))
    found = F.regexp_replace(strip(F.call_function("regexp_extract", text, rx, F.lit(1))), ",+$", "")
    return F.when(text.rlike(NBC_START) & (found != ""), title_case(found))


def nbc_summary(text: Column) -> Column:
    """What the norm ``dispõe sobre``, to the full stop, from the line that approves it."""
    found = F.regexp_extract(text, rf"(?iu)Aprova{D.S}+a{D.S}+NBC{D.S}+TG{D.S}+\d+,?{D.S}*(?:que{D.S}+)?(disp[õo]e{D.S}+sobre[^.]+\.)", 1)
    return F.when(found != "", F.regexp_replace(strip(found), f"{D.S}+", " "))


def objective(text: Column, limit: int = 500) -> Column:
    """Item 1 within 2,000 characters behind a line ``OBJETIVO``, else the first item 1 of 40 to 600 characters that
    another item, a letter or a title follows; blanks made one, at most ``limit`` characters."""
    after = F.regexp_extract(text, rf"(?md)^{D.S}*OBJETIVO{D.S}*$([\s\S]{{0,2000}})", 1)
    stated = F.regexp_extract(after, rf"(?msd)^{D.S}*1\.{D.S}+(.+?)(?=^{D.S}*(?:2\.|[A-Z]{{4,}}){D.S})", 1)
    following = rf"2\.|\(a\)|[A-Z][a-záéíóúãõç]+{D.S}*$|[{D.CAPS} ]{{3,}}$"
    first = F.regexp_extract(text, rf"(?msd)^{D.S}*1\.{D.S}+(.{{40,600}}?)(?=\n{D.S}*(?:{following}))", 1)
    found = F.when(stated != "", stated).otherwise(first)
    return F.when(found != "", F.left(F.regexp_replace(strip(found), f"{D.S}+", " "), F.lit(limit)))


def accounting_summary(text: Column) -> Column:
    """Summary of an accounting norm: what an NBC TG says it is about, else the objective."""
    nbc = text.rlike(NBC_START) & ~text.rlike(CPC_START)
    return F.coalesce(F.when(nbc, nbc_summary(text)), objective(text))


def title(text: Column, tail: int = 800) -> Column:
    """Title of an accounting norm; of an NBC TG the one behind its number, else from ``tail`` characters behind the header.

    There it is a line in capitals up to the first line of over 40 characters, else a line that starts with a
    capital and is no boilerplate, else a long line of mostly capitalised words. No header, no title.
    """
    cpc = text.rlike(CPC_START)
    behind = lambda head: F.regexp_extract(text, rf"{head}([\s\S]{{0,{tail}}})", 3)
    lines = F.filter(F.transform(split_lines(F.when(cpc, behind(CPC_START)).otherwise(behind(NBC_START))), strip), lambda x: x != "")
    upper = lambda x: x.rlike(r"\p{IsUppercase}") & ~x.rlike(r"[\p{IsLowercase}\p{Lt}]")
    long = first_match(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.length(F.get(lines, i)) > 40, lambda i: i + 1)
    top = F.slice(lines, F.lit(1), F.coalesce(long, F.size(lines)))
    caps = first_match(top, lambda x: upper(x) & F.length(x).between(5, 150) & ~x.rlike("CORRELA|IFRS|IAS"), lambda x: x)
    free = F.filter(lines, lambda x: ~x.rlike(TITLE_BLOCK))
    short = first_match(free, lambda x: F.length(x).between(3, 130) & x.rlike(r"^\p{IsUppercase}") & ~x.rlike(r"[.,]$"), lambda x: x)
    short = F.regexp_replace(short, rf"{D.S}+Correla[çc][ãa]o[\s\S]*$", "")
    words = lambda x: F.filter(F.split(x, f"{D.S}+"), lambda w: w != "")
    capital = lambda x: F.size(F.filter(words(x), lambda w: w.rlike(r"^\p{IsUppercase}")))
    mostly = first_match(free, lambda x: (F.length(x) > 15) & (F.size(words(x)) >= 3) & (capital(x) >= F.size(words(x)) * 0.6), lambda x: x)
    found = F.when(F.size(lines) > 0, F.coalesce(title_case(caps), title_case(short), mostly))
    return F.when(cpc, found).when(text.rlike(NBC_START), F.coalesce(nbc_title(text), found))


def title_case(text: Column, small: Sequence[str] = SMALL_WORDS) -> Column:
    """Each word with a capital and the rest in lower case, small words in lower case but for the first; a lone
    last lower-case letter or digit (a note's mark) goes."""
    def word(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when((i > 0) & low.isin(*small), low).otherwise(F.concat(F.upper(F.left(low, F.lit(1))), F.substr(low, F.lit(2))))

    text = F.regexp_replace(strip(text), rf"^(.{{4,}}{D.NOT_S}){D.S}+[a-z0-9]$", "$1")
    return F.array_join(F.transform(F.filter(F.split(text, f"{D.S}+"), lambda w: w != ""), word), " ")


def fingerprint(content: Column) -> Column:
    return F.left(F.sha2(content, 256), F.lit(16))
