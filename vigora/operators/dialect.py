"""Dialects of structured documents: the patterns and levels by which lines are told apart.

Patterns are written so that Java's engine and RE2 read them alike: classes are spelled out, no
look-around; ``ci`` patterns ignore case. A dialect is a parameter; the two presets are the law's and
that of accounting pronouncements.
"""

from __future__ import annotations

from dataclasses import dataclass, field

#: Unicode white space and line ends.
INSIDE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S = f"[{INSIDE}]"
NOT_S = f"[^{INSIDE}]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
END = r"(?:[^\p{L}\p{N}_]|$)"
CAPS = "A-ZÁÉÍÓÚÂÊÔÃÕÇ"


@dataclass(frozen=True)
class Dialect:
    """``noise``: lines that carry page furniture; ``start``: lines that begin a structural unit."""

    name: str
    noise: tuple[str, ...]
    start: str
    start_ci: bool
    titles: bool = False
    orphans: bool = False
    levels: dict[str, int] = field(default_factory=dict)


# Page furniture, division names and types of norms.
LAW_NOISE = (
    rf"^{S}*p[áa]gina{S}+\d+{S}*(?:de{S}+\d+)?{S}*$",
    rf"^{S}*fls?\.?{S}*\d+{S}*$",
    rf"^{S}*\d{{1,4}}{S}*$",
    rf"^{S}*di[áa]rio{S}+oficial.*$",
    rf"^{S}*imprensa{S}+nacional.*$",
    rf"^{S}*este{S}+texto{S}+n[ãa]o{S}+substitui.*$",
    rf"^{S}*www\.{NOT_S}+$",
)
ACCOUNTING_NOISE = (
    LAW_NOISE[0],
    LAW_NOISE[2],
    LAW_NOISE[6],
    rf"^{S}*comit[êe]{S}+de{S}+pronunciamentos?{S}+cont[áa]beis?{S}*$",
    rf"^{S}*CPC{S}+\d+.*p[áa]gina.*\d+.*$",
)
LAW_START = (
    rf"^{S}*(?:LIVRO|T[ÍI]TULO|CAP[ÍI]TULO|SE[ÇC][ÃA]O|SUBSE[ÇC][ÃA]O|Art\.?{S}*\d|Artigo{S}*\d|§{S}*\d"
    rf"|Par[áa]grafo{S}+[úu]nico|[IVXLCDM]{{1,6}}{S}*[-–—]{S}|[a-z]\){S}|\d{{1,2}}\){S})"
)
# a line in capitals has no greatest length: it is read by one class, as Java's engine takes stack for each turn of a group
ACCOUNTING_START = (
    rf"^{S}*(?:[{CAPS}][{CAPS}\-{INSIDE}]{{3,}}$|AP[ÊE]NDICE{S}+[A-Z]|\d+[A-Z]?\.{S}|[A-Z]\d+[A-Z]?\.{S}|\([a-z]\){S})"
)
LEVELS = {
    "LIVRO": 1, "TÍTULO": 2, "TITULO": 2, "CAPÍTULO": 3, "CAPITULO": 3,
    "SEÇÃO": 4, "SECAO": 4, "SEÇAO": 4, "SUBSEÇÃO": 5, "SUBSECAO": 5,
}
OTHER_LEVEL = 3
TYPES = (
    ("LEI COMPLEMENTAR", "LC"), ("EMENDA CONSTITUCIONAL", "EC"), ("MEDIDA PROVISÓRIA", "MP"), ("INSTRUÇÃO NORMATIVA", "IN"),
    ("LEI", "Lei"), ("DECRETO-LEI", "Decreto-Lei"), ("DECRETO", "Decreto"), ("PORTARIA", "Portaria"), ("RESOLUÇÃO", "Resolução"),
    ("CONSTITUIÇÃO", "Constituição"), ("ATO CONJUNTO", "Ato Conjunto"), ("ATO DECLARATÓRIO", "Ato Declaratório"),
)

LAW = Dialect("law", LAW_NOISE, LAW_START, True, levels=LEVELS)
ACCOUNTING = Dialect("accounting", ACCOUNTING_NOISE, ACCOUNTING_START, False, titles=True, orphans=True)

# Headers, notes and references of both dialects.
ANNEX = rf"^ANEXO{END}"
DIVISION = rf"^(LIVRO|T[ÍI]TULO|CAP[ÍI]TULO|SE[ÇC][ÃA]O|SUBSE[ÇC][ÃA]O)(?:[^\p{{L}}\p{{N}}_].*)?$"
ARTICLE = rf"^(?:Art\.|Artigo){S}*(\d+[ºo]?(?:-[A-Z])?){S}*[.\-–—]?{S}*(.*)$"
REF_TAIL = r"^[a-zà-ú]"
NOTE = r"\((?:Reda[çc][ãa]o|Revogad|Inclu[íi]d|Vide|Vigência)[^)]*\)"
REF = rf"art(?:igo|\.)?{S}*(\d+[ºo]?(?:-[A-Z])?)"
PARAGRAPH = rf"^(§{S}*\d+[ºo]?|Par[áa]grafo{S}+[úu]nico)\.?{S}*(.*)$"
ROMAN = rf"^([IVXLCDM]{{1,6}}){S}*[-–—]{S}*(.*)$"
LETTER = rf"^([a-z])\){S}*(.*)$"
NUMBERED = rf"^(\d{{1,2}})\){S}*(.*)$"

APPENDIX = rf"^AP[ÊE]NDICE{S}+([A-Z])(?:{S}*[–\-—]{S}*(.+))?"
ITEM_APPENDIX_DEEP = rf"^([A-Z])\.?(\d+(?:\.\d+)+[A-Z]?){S}+(.+)$"
ITEM_APPENDIX = rf"^([A-Z])(\d+[A-Z]?)\.{S}+(.+)$"
ITEM_DEEP = rf"^(\d+(?:\.\d+)+[A-Z]?){S}+(.+)$"
ITEM = rf"^(\d+[A-Z]?)\.{S}+(.+)$"
ITEM_P = rf"^(P\d+[A-Z]?){S}+(.+)$"
ALINEA = rf"^\(([a-z])\){S}+(.+)$"
SUBITEM = rf"^\(([ivxlcdm]+)\){S}+(.+)$"
SECTION = rf"^[{CAPS}](?:[{CAPS}\-]|{S}){{2,}}$"
ACCOUNTING_NOTE = r"\((?:Reda[çc][ãa]o|Revogad|Inclu[íi]d|Vide|Vig[êe]ncia)[^)]*\)"
ITEM_REF = rf"(?:^|[^\p{{L}}\p{{N}}_])item{S}+(\d+[A-Z]?)"
REVISED = rf"\((?:Alterad|Revis[ãa]o|Substitu[íi]d|Nova{S}+reda)"
FIRST_SECTION = "OBJETIVO"
