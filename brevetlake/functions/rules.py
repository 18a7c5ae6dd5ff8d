"""Text repair by ordered rules: each rule works on what the ones before have left."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """Replace `pattern` by `to`: literally, or as a regular expression; only where `when` (a regular expression) is found, if given."""

    pattern: str
    to: str
    regex: bool = False
    when: str | None = None


def repair(c: Column, rules: Sequence[Rule]) -> Column:
    """The text after all rules.

    A rule's input stands in its expression once; conditional rules that follow each other are one fold over an array, as
    nested conditions would double the expression with each rule.
    """
    for conditional, run in groupby(rules, key=lambda r: r.when is not None):
        c = _fold(c, list(run)) if conditional else reduce(_plain, run, c)
    return c


def _plain(c: Column, rule: Rule) -> Column:
    return F.regexp_replace(c, rule.pattern, rule.to) if rule.regex else F.replace(c, F.lit(rule.pattern), F.lit(rule.to))


def _fold(c: Column, rules: Sequence[Rule]) -> Column:
    table = F.array(*(F.struct(F.lit(r.pattern).alias("pattern"), F.lit(r.to).alias("to"), F.lit(r.regex).alias("regex"), F.lit(r.when).alias("when")) for r in rules))

    def step(text: Column, r: Column) -> Column:
        new = F.when(r["regex"], F.regexp_replace(text, r["pattern"], r["to"])).otherwise(F.replace(text, r["pattern"], r["to"]))
        return F.when(F.rlike(text, r["when"]), new).otherwise(text)

    return F.aggregate(table, c, step)


def misread(letters: str) -> list[Rule]:
    """Rules for letters whose UTF-8 bytes were read as Latin-1, longest first so that none hides another."""
    rules = [Rule(x.encode().decode("latin-1"), x) for x in letters]
    return sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))


def rules_of(table: Sequence[tuple[str, str]], regex: bool = False) -> list[Rule]:
    """Rules in the order of a table of (wrong, right) texts, such as one of single names that a user keeps."""
    return [Rule(a, b, regex) for a, b in table]


# Spoilt words and signs in names, and what they are, in the order in which they are repaired.
NAME_REPAIRS = (
    ("FRAN\ufffdOIS", "FRANÇOIS"),
    ("C\ufffdDRIC", "CÉDRIC"),
    ("S\ufffdBASTIEN", "SÉBASTIEN"),
    ("V\ufffdRONIQUE", "VÉRONIQUE"),
    ("JER\ufffdME", "JÉRÔME"),
    ("BENO\ufffdT", "BENOÎT"),
    ("FR\ufffdD\ufffdRIC", "FRÉDÉRIC"),
    ("UNIVERSIT\ufffd", "UNIVERSITÉ"),
    ("SJ\ufffdDIN", "SJÖDIN"),
    ("SANT\ufffd", "SANTÉ"),
    ("[NSERM", "INSERM"),
    ("L & RSQUO EN", "L'ENERGIE"),
    ("L+ENERGIE", "L'ENERGIE"),
    ("WALTER+ELIZA", "WALTER AND ELIZA"),
    ("L/OREAL", "L'OREAL"),
    ("1/1", ""),
    ("(1/4)", ""),
    ("|’alimentation", "l’alimentation"),
    ("Mikl¢s", "Miklós"),
    ("Soci§té", "Société"),
    ("ChÃªne", "Chêne"),
    ("Benoí®t", "Benoît"),
    ("(INSERM°", "(INSERM)"),
    ("(PARIS 6°", "(PARIS 6)"),
    ("FRANA§OIS", "FRANÇOIS"),
    ("Franí§ois", "François"),
    ("SJ\\DIN", "SJÖDIN"),
    ("STE]PHANE", "STÉPHANE"),
    ("TECHNIGAZ_", "TECHNIGAZ"),
    ("i′", "ì"),
    ("e′", "é"),
    ("a′", "à"),
    ("A′", "À"),
    ("é´", "é"),
)
# Letters that stand for a Latin one where they are the only foreign ones of a name.
LONE_LETTERS = (("С", "C"), ("Σ", "Ç"), ("ё", "ë"), ("ς", "ç"), ("Ι", "I"), ("Χ", "X"), ("\u0650", ""), ("Ί", "Í"), ("\u064f", ""))


# Signs that spoil any name, and what they stand for, in the order in which they are repaired; True marks regular expressions.
SIGN_REPAIRS = (
    ("\x92", "'", False),
    ("\x96", "", False),
    ("\x94", "", False),
    ("\x82", "é", False),
    ("\x8a", "è", False),
    ("\x8b", "ï", False),
    ("\x9a", "Ü", False),
    ("\x81", "ü", False),
    ("\x89", "ë", False),
    ("β", "ß", False),
    ("\x8c", "ï", False),
    ("\x87", "ç", False),
    ("\x93", "ô", False),
    ("Ã", "É", False),
    ("Ã\x80", "À", False),
    ("\x95", "ò", False),
    ("\x90", "É", False),
    ("\x99", "Ö", False),
    ("\xa0", "á", False),
    ("\u200b", "", False),
    ("公司", "", False),
    ("Ãº", "Ú", False),
    ("Ã¨", "É", False),
    ("Ã¼", "Ü", False),
    ("Ã«", "Ë", False),
    ("A«", "Ë", False),
    ("Ã©", "É", False),
    ("A©", "É", False),
    ("Ã´", "Ô", False),
    ("Ã®", "î", False),
    ("Ã¿", "Ó", False),
    ("L¿", "L'", False),
    ("¿", "-", False),
    ("ï¿½", "É", False),
    (" ¨ 1 ", "Ü", False),
    ("#34", "", False),
    (" (25%)", "", False),
    ("\\n", "", False),
    ("=", "", False),
    ("´", "'", False),
    ("′", "'", False),
    ("\u0301", "'", False),
    ("`", "'", False),
    (r"•\s?", "", True),
    (r"\.?\*{1,}", "", True),
    (r"^:\s{0,}", "", True),
    (r"\s{0,}:\s{0,}$", "", True),
    (r"^;\s{0,}", "", True),
    (r"\s{0,};\s{0,}$", "", True),
    (r"^03;", "", True),
    (r"\s{0,}\[$", "", True),
    (r"\[FR\]|\(FR\)", "", True),
    ("_", "-", False),
    ("‐", "-", False),
    ("–", "", False),
    ("—", " ", False),
    ("‘", "", False),
    ("’", "", False),
    ("“", "", False),
    ("”", "", False),
    ("{grave over ( )}", "", False),
    ("{dot over (o)}", "ó", False),
    ("{hacek over (o)}", "ô", False),
    ("{hacek over (s)}", "s", False),
    ("{hacek over (a)}", "ă", False),
    ("{dot over (O)}", "Ô", False),
    ("{dot over (A)}", "À", False),
    ("{hacek over (e)}", "ë", False),
    ("{hacek over (i)}", "î", False),
    ("ti{acute over (f)}", "íf", False),
    ("ë{umlaut over ( )}", "é", False),
    ("M{circumflex over (D)}DICALE", "MÉDICALE", False),
    ("TÃ\x9cRKE, Thomas", "TÜRKE, Thomas", False),
    ("|", "", False),
    (" ¨ ¢ ", "A", False),
    ("¤", "", False),
    ("Ã§", "Ç", False),
    (r"§$", "", True),
    ("\xad", "", False),
    ("Ã³", "Ó", False),
    ("Å", "À", False),
    ("Ϊ", "Ï", False),
    (" −", "", False),
    (r"\s?\}$", "", True),
)


def sign_rules() -> list[Rule]:
    """Repairs of signs in names, in order; the angle brackets of `name_rules` come after them."""
    return [Rule(*r) for r in SIGN_REPAIRS]


def triggers(rules: Sequence[Rule]) -> str:
    """One regular expression that is found in every text that a rule changes: a text without it passes all rules as it is."""
    return "|".join(r.pattern if r.regex else r"\Q" + r.pattern + r"\E" for r in rules)


def repair_where_needed(c: Column, rules: Sequence[Rule]) -> Column:
    """The text after all rules (without conditions), in order.

    One scan tells whether any rule has something to do; only then do the rules run, one after the other over a table.  The table
    is one literal, so the plan is as large for a thousand rules as for one.
    """
    if any(r.when is not None for r in rules):
        raise ValueError("conditional rules are for repair()")
    if not rules:
        return c
    table = F.from_json(F.lit(json.dumps([r._asdict() for r in rules])), "array<struct<pattern: string, to: string, regex: boolean>>")
    step = lambda text, r: F.when(r["regex"], F.regexp_replace(text, r["pattern"], r["to"])).otherwise(F.replace(text, r["pattern"], r["to"]))
    return F.when(c.rlike(triggers(rules)), F.aggregate(table, c, step)).otherwise(c)


def name_rules() -> list[Rule]:
    """All repairs of names that are not single names: words and signs in order, angle brackets but for the one name that has them, lone foreign letters."""
    lone = "".join(a for a, _ in LONE_LETTERS)
    latin = rf"^[\p{{IsLatin}}\p{{N}}\p{{P}}\p{{S}}\p{{Z}}\s{lone}]*$"
    return [*rules_of(NAME_REPAIRS), Rule("[<>]+", "", True, when=r"^(?!B<>COM$)"), *(Rule(a, b, when=latin) for a, b in LONE_LETTERS)]


#: French and German letters in either case.
ACCENTED = "àâäçéèêëîïôöùûüÿñÀÂÄÇÉÈÊËÎÏÔÖÙÛÜÑß"

#: Cyrillic and Greek capitals that look like Latin ones, replaced in names that are Latin otherwise.
LOOKALIKES = [Rule(a, b, when="[A-Za-z]") for a, b in zip("АВЕКМНОРСТХΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEKMHOPCTXABEZHIKMNOPTYX", strict=True)]


def is_latin(c: Column) -> Column:
    """Only Latin letters, digits, punctuation, spaces and marks."""
    return F.length(F.regexp_replace(c, r"[\p{IsLatin}\p{N}\p{P}\p{S}\p{Z}\p{M}\s]", "")) == 0
