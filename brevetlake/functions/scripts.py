"""Transliteration to ASCII by Unicode's own names of letters."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First and last code points of the scripts, and whether a letter is written as its whole name (syllables) or by its sound.
SCRIPTS = ((0x0370, 0x03FF, False), (0x0400, 0x04FF, False), (0x0531, 0x0586, False), (0x05D0, 0x05EA, False), (0x0621, 0x064A, False), (0x10A0, 0x10FF, False), (0x3041, 0x30FE, True))
_NAME = re.compile(r"(?:GREEK|CYRILLIC|ARMENIAN|HEBREW|ARABIC|GEORGIAN|HIRAGANA|KATAKANA) (?:CAPITAL LETTER |SMALL LETTER |LETTER )(?:FINAL |SHORT |SMALL |YIDDISH )?(.+)")


def sound(name: str) -> str:
    """What a letter sounds like by its name: its first consonants, or its first vowel.

    Names such as EL and EM have their consonant last, YA and YU are written whole, IE is an e, hard and soft signs are mute.
    """
    if name.endswith(" SIGN"):
        return ""
    word = name.split(" ")[0]
    if re.fullmatch(r"E[FLMNRS]", word):
        return word[1].lower()
    if re.fullmatch(r"Y[AEIOU]", word):
        return word.lower()
    if word == "IE":
        return "e"
    return re.match(r"[^AEIOU]+|[AEIOU]", word)[0].lower()


@lru_cache(1)
def letters() -> dict[str, str]:
    """Every letter of the scripts and its transliteration, made by the rule; letters with marks as their base, but for syllables."""
    out = {}
    for first, last, whole in SCRIPTS:
        for point in range(first, last + 1):
            base = chr(point) if whole else unicodedata.normalize("NFD", chr(point))[:1]
            found = _NAME.fullmatch(unicodedata.name(base, ""))
            if found:
                out[chr(point)] = found[1].split(" ")[-1].lower() if whole else sound(re.split(r" WITH ", found[1])[0])
    return out


def beyond_ascii(members: str) -> str:
    """A pattern for one of these characters, none of them in ASCII, or with ^ before them for any other outside ASCII: most characters are told by the first range, and long lists are not read for them."""
    return rf"[\x{{80}}-\x{{10FFFF}}&&[{members}]]"


def once(c: Column, step: Callable[[Column], Column]) -> Column:
    """`step` of a column that it names more than once, worked out once."""
    return F.get(F.transform(F.array(c), step), 0)


def transliterated(c: Column) -> Column:
    """The text with letters of the scripts written in ASCII, lower case; all else stays.

    Letters that become one letter, or none, are translated in one step; texts that hold others are then taken apart by letter.
    """
    single = sorted((k for k, v in letters().items() if len(v) < 2), key=lambda k: (letters()[k] == "", k))
    c = F.translate(c, "".join(single), "".join(letters()[k] for k in single))
    several = {k: v for k, v in letters().items() if len(v) > 1}
    table = F.from_json(F.lit(json.dumps(several)), "map<string, string>")
    by_letter = lambda c: F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(r"^[\x00-\x7F]"), x).otherwise(F.coalesce(F.element_at(table, x), x))), "")
    return once(c, lambda x: F.when(x.rlike(beyond_ascii("".join(sorted(several)))), by_letter(x)).otherwise(x))
