"""Text functions as columns.  What Spark has no expression for (accents, title case, HTML) is one Arrow batch function each."""

from __future__ import annotations

import html
import json
import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import formulas, scripts
from .scripts import transliterated

#: The ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def trimmed(c: Column) -> Column:
    """White space of any kind gone at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def single_spaced(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s{2,}", " ")


def without_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def without_punctuation(c: Column, keep: str = "") -> Column:
    """ASCII punctuation, but for `keep`, turned into spaces; then single-spaced and trimmed."""
    gone = "".join(p for p in PUNCTUATION if p not in keep)
    return trimmed(single_spaced(F.translate(c, gone, " " * len(gone))))


def is_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


@F.pandas_udf(T.StringType())
def without_accents(texts: pd.Series) -> pd.Series:
    plain = lambda t: "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
    return texts.map(plain, na_action="ignore")


@F.pandas_udf(T.StringType())
def title_case(texts: pd.Series) -> pd.Series:
    """A capital after everything that is not a letter, as in Jean-Pierre O'Neil."""
    return texts.map(str.title, na_action="ignore")


def without_words(c: Column, pattern: str) -> Column:
    return trimmed(F.regexp_replace(c, pattern, ""))


def clean_name(c: Column, patterns: Sequence[str] = ()) -> Column:
    """Lower case, without accents and punctuation, then without each pattern in turn."""
    c = without_punctuation(without_accents(F.lower(c)))
    for pattern in patterns:
        c = without_words(c, pattern)
    return c


def words_in_order(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def initials(c: Column) -> Column:
    """First letter of each word; no entries for the empty text."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, " "), lambda w: F.substring(w, 1, 1)))


def has_initial(c: Column) -> Column:
    return F.exists(F.split(c, " "), lambda w: F.length(w) == 1)


def has_several_names(c: Column) -> Column:
    """More than two parts by any of the separators."""
    out = F.lit(False)
    for separator in (",", ";", "/", ",,"):
        out = out | (F.size(F.split(c, separator, -1)) > 2)
    return out


def display_name(c: Column) -> Column:
    """A name to show: without the doctor's title, hyphens, dots and apostrophes kept, in title case."""
    return title_case(without_punctuation(F.regexp_replace(F.lower(c), r"^dr ", ""), keep="'-."))


def address_line(c: Column) -> Column:
    """A French address without delivery notes (cedex, post boxes) and country."""
    # The patterns of delivery notes, applied in this order.
    for pattern in (r"cedex(\s)?(\d)*", r"c(\s)?s(\s)?(\d)+", r"b(\s)?p\s(\d)+", r"\sfr\s", r"\sfr$", r"^fr$", r"\sbp(\s)?(\d)+", r"\sf\s"):
        c = F.regexp_replace(c, pattern, " ")
    return trimmed(single_spaced(c))


def address_key(c: Column) -> Column:
    """An address for lookups: lower case, letters, digits and single spaces only."""
    # Patterns and replacements, applied in this order.
    steps = ((r"(?i)f-{0,}(\d+)", "$1"), (r"[\"']", " "), (r"[«»]", ""), ("﻿3", ""), (r"^-+\s?", ""), (r"^\.+\s?", ""), (r"^/+\s?", ""), ("&", " "), (r",\s{0,}", " "), (r"_{1,}", " "), (r"[c|C]/[o|O]", ""), (r"\s+", " "), (r"(?i)cedex\s{0,}\d{1,2}", ""), (r"[^\p{L}\p{N} ]", " "), (r"\s+", " "))
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return F.trim(F.lower(c))


def department(c: Column) -> Column:
    """First two digits of the last group of five; empty without any."""
    codes = F.regexp_extract_all(c, F.lit(r"(\d{5})"), 1)
    return F.when(F.size(codes) > 0, F.substring(F.element_at(codes, -1), 1, 2)).otherwise("")


def postcode_and_city(c: Column) -> Column:
    """From the last five digits on; empty without any."""
    return trimmed(single_spaced(F.regexp_extract(c, r"(?s)^.*(\d{5}.*)$", 1)))


def only_postcode(c: Column) -> Column:
    """The one token of five digits; empty where there are none or several different ones."""
    codes = F.array_distinct(F.filter(F.split(c, r"[,\s]+"), lambda w: w.rlike(r"^\d{5}$")))
    return F.when(F.size(codes) == 1, F.get(codes, 0)).otherwise("")


def valid_siren(c: Column) -> Column:
    """Nine digits once punctuation and spaces are gone, not all zero; else null."""
    bare = without_spaces(without_punctuation(c))
    return F.when(bare.rlike(r"^\d{9}$") & (bare != "000000000"), bare)


def siren_of_siret(c: Column) -> Column:
    bare = without_spaces(c)
    return F.when(bare.rlike(r"^\d{14}$"), F.substring(bare, 1, 9))


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}]", "")


def tuple_items(c: Column) -> Column:
    """Items of a printed tuple such as ('a', 'b')."""
    bare = F.regexp_replace(c, r"^\(|\)$", "")
    return F.filter(F.transform(F.split(bare, r",\s*"), lambda x: F.regexp_replace(x, r"^'|'$", "")), lambda x: x != "")


def dois(c: Column) -> Column:
    """All DOIs of a text, trimmed, in lower case, each once."""
    # Fixed value: the pattern of a DOI, in which the first dot stands for any character.
    found = F.regexp_extract_all(c, F.lit(r"(10.\d{4,9}/[-._;()/:a-z0-9A-Z]+)"), 1)
    return F.array_distinct(F.transform(found, lambda d: F.lower(F.trim(d))))


#: Prefixes and signs that a written DOI loses, in this order.
DOI_RULES = (
    (r"(?i)^doi\s?:?", ""),
    (r"\*\s?", ""),
    (r"(?i)https?://dx\.doi\.org/", ""),
    (r"(?i)dx\.doi\.org/", ""),
    (r"(?i)https?://doi\.org/", ""),
    (r":\s?", ""),
    (r"(?i)^\.org/", ""),
    (r"^/", ""),
    (r"(\.\?)|(\?\.)", "."),
    (r"/\?", "/"),
    (r"\?", "-"),
    (r"(?i)https?//onlinelibrary\.wiley\.com/doi/", ""),
    (r"(?i)https?//:?rd\.springer\.com/article/", ""),
    (r"(?i),availableonlineathttp//www\.idealibrary\.comon", ""),
)
#: Single DOIs that were written wrongly and what they are, in this order; in either case.
DOI_REPAIRS = (
    ("10.3390/molecules 171214205", "10.3390/molecules171214205"),
    ("10.1638/1042-7260(2000)031 0512ITCCOM!2.0.CO;2", "10.1638/1042-7260(2000)031[0185:oioawd]2.0.co;2"),
    ("10. 1 387!ijdb.0929480w", "10.1387/ijdb.092948ow"),
    ("10.1101/ 2020.09.15.298257", "10.1101/2020.09.15.298257"),
    ("10.1016/ S2213-2600(20)30225-3", "10.1016/s2213-2600(20)30225-3"),
    ("10.1016/j.surfcoat. 2008.05.04 7", "10.1016/j.surfcoat.2008.05.047"),
    ("10.1295/POLYMJ.20.477 10.1295/POLYMJ.20.477", "10.1295/polymj.20.477"),
    ("10.1016/j.petrol. 2016.07.00 2", "10.1016/j.petrol.2016.07.002"),
    ("10.1016/j.ajpath. 2014.11.02 9", "10.1016/j.ajpath.2014.11.029"),
    ("10.1081/SCC-200048974 10.1081/SCC-200048974", "10.1081/SCC-200048974"),
    ("10.1517/13543776.2011.542412 CR", "10.1517/13543776.2011.542412"),
    ("10.1007/s11771 010 0033 3", "10.1007/s11771-010-0033-3"),
    ("10.7326/M15-2994 pubmed26999484", "10.7326/M15-2994"),
    ("10.3109/14756369709027648 10.3109/14756369709027648", "10.3109/14756369709027648"),
    ("10.1016/ j.tibtech.2013.04.004", "10.1016/j.tibtech.2013.04.004"),
    ("10.1 0L 6/ J.SOLMAT.2017 .06.023", "10.1016/j.solmat.2017.06.023"),
    ("10.1002/(SICI)1521-396X(199911)1761<297AID-PSSA297>3.0.CO; 2-Z", "10.1002/(SICI)1521-396X(199911)176:1<297::AID-PSSA297>3.0.CO;2-Z"),
    ("10.1002/ANIE.201608520 10.1002/ANIE.201608520", "10.1002/anie.201608520"),
    ("10.1016/0022-328X(95)05701-P 10.1016/0022-328X(95)05701-P", "10.1016/0022-328X(95)05701-P"),
    ("10.1016/J.OMTN.2018.09.006 PUBLISHER", "10.1016/J.OMTN.2018.09.006"),
    ("10.1016/J.TETLET.2003.11.131 10.1016/J.TETLET.2003.11.131", "10.1016/j.tetlet.2003.11.131"),
    ("10.1016/S0031-9422(00)00274-0 10.1016/S0031-9422(00)00274-0", "10.1016/S0031-9422(00)00274-0"),
    ("10.1016/S0040-4039(03)01075-X 10.1016/S0040-4039(03)01075-X", "10.1016/S0040-4039(03)01075-X"),
    ("10.1016/S1473-3099(14)71047-3 pubmed25435054", "10.1016/S1473-3099(14)71047-3"),
    ("10.1016/j.asoc. 2018.05.01 8", "10.1016/j.asoc.2018.05.018"),
    ("10.1016/j.cyto.2011.07.396 IRN - ISSN 1", "10.1016/j.cyto.2011.07.396"),
    ("10.1016/j.jaccas. 2020.04.05 3", "10.1016/j.jaccas.2020.04.053"),
    ("10.1080/10575630008043769 10.1080/10575630008043769", "10.1080/10575630008043769"),
    ("10.1093/JXB/ERP061 10.1093/JXB/ERP061", "10.1093/JXB/ERP061"),
    ("10.1111/ics. 12512", "10.1111/ics.12512"),
    ("10.1134/S1054660X10030060 Î", "10.1134/S1054660X10030060"),
    ("10.1371/journal.pone.0033490 pubmed22432029", "10.1371/journal.pone.0033490"),
    ("10.1517/13543776.2012.733000 CR", "10.1517/13543776.2012.733000"),
    ("10.4271/ 2009-01-11 43", "10.4271/2009-01-1143"),
    ("10.1.1.14.6782", "10.1109/TNSRE.2002.1021581"),
    ("10.1.1.75.1021", "10.5281/zenodo.40463"),
)


def clean_doi(c: Column) -> Column:
    """A written DOI without prefixes and signs, in lower case: single repairs come after the rules, and only then do spaces go."""
    for pattern, to in DOI_RULES:
        c = F.regexp_replace(c, pattern, to)
    table = F.array(*(F.struct(F.lit(a.lower()).alias("a"), F.lit(b.lower()).alias("b")) for a, b in DOI_REPAIRS))
    c = F.lower(c)
    # Every repair starts like a DOI with a space, a sign that DOIs lack, or one of few others: most texts skip the table.
    odd = c.rlike(r"\s|!|10\.1\.1\.")
    c = F.when(odd, F.aggregate(table, c, lambda text, r: F.replace(text, r["a"], r["b"]))).otherwise(c)
    return F.replace(F.regexp_replace(c, r"\s+", ""), F.lit("//"), F.lit("/"))


#: The widest range of house numbers that is expanded.
STREET = 10_000


def house_numbers(c: Column) -> Column:
    """The different numbers of a house-number text, in order; what is no int is no house number."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), 1), lambda n: n.try_cast("int")), F.isnotnull)))


def house_range(c: Column) -> Column:
    """All numbers from the first to the last with the parity of the first, where there are two that a street can hold (`STREET` apart at most); else the numbers themselves."""
    n = house_numbers(c)
    return F.when((F.size(n) == 2) & (F.get(n, 1).cast("long") - F.get(n, 0) <= STREET) & (F.pmod(F.get(n, 0), F.lit(2)) == F.pmod(F.get(n, 1), F.lit(2))), F.sequence(F.get(n, 0), F.get(n, 1), F.lit(2))).otherwise(n)


def department_id(c: Column) -> Column:
    return F.concat(F.lit("D"), F.lpad(c, 3, "0"))


@F.pandas_udf(T.StringType())
def repaired_encoding(texts: pd.Series) -> pd.Series:
    """Text that was read as Latin-1 but is UTF-8, read again; unprintable characters go."""

    def repair(t: str) -> str:
        try:
            t = t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            pass
        return "".join(x for x in t if x.isprintable())

    return texts.map(repair, na_action="ignore")


#: Letters without a decomposition, and what they become in ASCII.
_ASCII = str.maketrans({"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "þ": "th", "ı": "i", "’": "'", "–": "-", "—": "-"})


@lru_cache(1)
def _ascii_letters() -> dict[str, str]:
    """What each character outside ASCII that decomposes becomes there, in lower case; all others go."""
    out = {}
    for x in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]):
        if ord(x) in _ASCII or unicodedata.decomposition(x):
            found = unicodedata.normalize("NFKD", x.translate(_ASCII)).encode("ascii", "ignore").decode().lower()
            if found:
                out[x] = found
    return out


def to_ascii(c: Column) -> Column:
    """Lower case in ASCII: letters of other scripts by their sounds, others as far as they decompose; what is left, as Chinese characters, goes.

    Characters that become one are translated in one step; a text that holds any that become more is cut at these only.
    """
    letters = _ascii_letters()
    single = [k for k, v in letters.items() if len(v) == 1]
    several = {k: v for k, v in letters.items() if len(v) > 1}
    sign, cut = r"[^\x00-\x7F]", "\x80"
    table = F.from_json(F.lit(json.dumps(several)), "map<string, string>")
    c = F.translate(transliterated(c), "".join(single), "".join(letters[k] for k in single))
    c = F.regexp_replace(c, rf"{scripts.beyond_ascii('^' + ''.join(several))}+", "")
    # What is left holds no other sign outside ASCII, so one of them marks where it is cut.
    parts = lambda x: F.split(F.regexp_replace(x, f"({sign})", f"{cut}$1{cut}"), cut)
    written = lambda x: F.array_join(F.transform(parts(x), lambda p: F.when(p.rlike(f"^{sign}"), F.element_at(table, p)).otherwise(p)), "")
    return F.lower(scripts.once(c, lambda x: F.when(x.rlike(sign), written(x)).otherwise(x)))


class _Flat(HTMLParser):
    """Text of a fragment; tags of formulas stay as they are written, without attributes."""

    KEPT = frozenset({"i", "sup", "sub", "u", "b"})

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in self.KEPT:
            self.out.append(f"<{tag}>")
        elif tag == "tex":
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in self.KEPT:
            self.out.append(f"</{tag}>")
        elif tag == "tex":
            self.out.append(" ")

    def handle_data(self, data):
        self.out.append(data)


def plain_formula(t: str) -> str:
    """Formulas without their markup: those between dollar signs, and all commands anywhere."""
    t = re.sub(r"\$(.*?)\$", lambda m: formulas.plain(m[1]), t)
    return formulas.plain(t) if "\\" in t else t


def scientific_text(t: str) -> str:
    before = None
    while before != t:
        before, t = t, html.unescape(t)
    flat = _Flat()
    flat.feed(unquote(t))
    flat.close()
    t = unicodedata.normalize("NFKC", plain_formula("".join(flat.out)))
    t = re.sub(r"[\x00-\x1F\x7F]", "", t)
    t = re.sub(r"[‐–—]", "-", t)
    t = re.sub(r"([A-Za-z])([ΣΔαβγμ])", r"\1 \2", t)
    t = re.sub(r"([ΣΔαβγμ])([A-Za-z])", r"\1 \2", t)
    return re.sub(r"\s+", " ", t).strip()


@F.pandas_udf(T.StringType())
def clean_scientific(texts: pd.Series) -> pd.Series:
    """Titles and abstracts without entities, URL codes, markup and formula codes, in one form of Unicode."""
    return texts.map(scientific_text, na_action="ignore")
