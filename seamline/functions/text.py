"""Column functions over names and labels; all run inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from seamline.functions import dictionaries as D


def type_of(word: Column) -> Column:
    """Canonical type of a type word, else null."""
    return F.create_map(*(F.lit(x) for pair in D.TYPE_WORDS.items() for x in pair))[word]


def is_direction(word: Column) -> Column:
    return word.isin(D.DIRECTIONS)


@cache
def _plain() -> tuple[str, str, dict[str, str]]:
    """Letters whose compatibility decomposition is one letter and marks, those letters, and what decomposes to several.

    Built from the Unicode table for all planes; marks themselves stand behind
    the letters, where a translation leaves them out.
    """
    marked, bare, several = [], [], {}
    marks = [chr(i) for i in range(0x20000) if unicodedata.combining(chr(i))]
    for i in range(0xA0, 0x20000):
        c = chr(i)
        if unicodedata.combining(c) or 0xD800 <= i < 0xE000 or 0xAC00 <= i < 0xD7A4 or c in "ßẞ":
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if base != c and len(base) == 1:
            marked.append(c)
            bare.append(base)
        elif base != c:
            several[c] = base
    return "".join(marked + marks), "".join(bare), several


def fold(text: Column) -> Column:
    """Sharp s as two letters, then without marks: the compatibility decomposition less its combining characters.

    Plain ASCII is left alone. Of the characters that decompose to several, those
    of ``LIGATURES`` are spelled out; the others and Hangul syllables stay whole.
    """
    marked, bare, several = _plain()
    doubled = F.replace(F.replace(text, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("SS"))
    spread = doubled
    for c in LIGATURES:
        spread = F.replace(spread, F.lit(c), F.lit(several[c]))
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(spread, marked, bare))


#: Fixed value: characters in names that decompose to several letters.
LIGATURES = "ĳĲŉǆǅǄǉǈǇǌǋǊǳǲǱﬀﬁﬂﬃﬄﬅﬆ½¼¾…№™"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.upper(F.regexp_replace(fold(text), "[^A-Za-z' ]+", " ")), " "), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _unturned(words: Column) -> Column:
    """Without a direction behind a type word."""
    n = F.size(words)
    turned = (n > 2) & is_direction(F.try_element_at(words, F.lit(-1))) & type_of(F.try_element_at(words, F.lit(-2))).isNotNull()
    return F.when(turned, F.slice(words, F.lit(1), n - 1)).otherwise(words)


def _suffix(last: Column) -> Column:
    """The type word fused to a name's last word, or null."""
    chosen = F.when(type_of(last).isNotNull(), F.lit(None).cast("string"))
    for word in D.FUSED_SUFFIXES:
        chosen = chosen.when(F.endswith(last, F.lit(word)) & (F.length(last) - len(word) >= 3), word)
    return chosen.when(F.endswith(last, F.lit("STR")) & (F.length(last) >= 7), "STR")


def _split_fused(words: Column) -> Column:
    last = F.try_element_at(words, F.lit(-1))
    stem = lambda s: F.when(s.isNull(), words).otherwise(
        F.concat(F.slice(words, F.lit(1), F.size(words) - 1), F.array(F.left(last, F.length(last) - F.length(s)), s))
    )
    return let(_suffix(last), stem)


def _named(words: Column) -> Column:
    typ = F.when(F.size(words) > 1, type_of(F.try_element_at(words, F.lit(-1))))
    rest = lambda t: F.when(t.isNull(), words).otherwise(F.slice(words, F.lit(1), F.size(words) - 1))
    cut = lambda t: F.named_struct(F.lit("name"), F.array_join(rest(t), " "), F.lit("typ"), t)
    return let(typ, cut)


def norm_label(text: Column) -> Column:
    """struct(name, typ): the name without its type word, and the canonical type or null."""
    split = let(let(_words(text), _unturned), lambda w: F.when(F.size(w) > 0, _split_fused(w)).otherwise(w))
    return let(split, _named)


def canon(text: Column) -> Column:
    """NAME TYPE."""
    return let(norm_label(text), lambda label: F.concat_ws(" ", label["name"], label["typ"]))


def spell_key(name: Column, exact: bool = False) -> Column:
    """A key that folds historic spellings: TH, PH, DT, hard C and a Y that is not initial; if ``exact``, the name itself."""
    s = F.upper(name)
    if exact:
        return s
    for old, new in (("TH", "T"), ("PH", "F"), ("DT", "T")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return F.regexp_replace(F.regexp_replace(s, "C(?=[AOULR])", "K"), "(?<=[A-Z])Y", "I")


def base_name(street: Column) -> Column:
    """A street without its canonical type word."""
    kinds = "|".join(sorted(set(D.TYPE_WORDS.values())))
    return F.regexp_replace(street, f" (?:{kinds})$", "")


def strip_leading(name: Column) -> Column:
    """A name without leading articles and prepositions; the last word always stays."""
    return F.regexp_replace(name, rf"^(?:(?:{'|'.join(D.LEADING)}) )+(?=\S)", "")


def strip_direction(name: Column) -> Column:
    """A name without a leading direction, or null if it has none."""
    pattern = rf"^(?:{'|'.join(D.DIRECTIONS)}) (?=\S)"
    return F.when(name.rlike(pattern), F.regexp_replace(name, pattern, ""))


def name_stem(street: Column) -> Column:
    base = base_name(street)
    return spell_key(F.coalesce(strip_direction(base), base))


def numeral(text: Column) -> Column:
    """The number a label reads as ("17", "16½", "BLOCK 50"), else null."""
    found = F.regexp_extract(F.trim(text), r"^(?i:BL(?:OC)?K\.?\s+)?([0-9]+(?:½|1/2)?)$", 1)
    return F.when(found != "", found)


def floors(numerals: Column) -> Column:
    """Floors told by a single number from 1 to 3, halves allowed, else null."""
    one = F.try_element_at(numerals, F.lit(1))
    whole = F.try_to_number(F.regexp_extract(one, "^([0-9]{1,4})(?:½|1/2)?$", 1), F.lit("9999")).cast("double")
    value = whole + F.when(one.rlike("(½|1/2)$"), 0.5).otherwise(0.0)
    return F.when((F.size(numerals) == 1) & value.between(1.0, 3.0), value)


def scale_statement(text: Column) -> Column:
    """struct(rank, feet) of a stated scale: 0 "SCALE 500", 1 "50 FEET = 1 INCH", 2 the same about sheets; null if none."""
    up = F.upper(text)
    first = F.regexp_extract(up, r"(?:SC)?ALE\W{0,4}([0-9]{2,4})\b", 1)
    second = F.regexp_extract(up, r"\b([0-9]{2,4})\s*(?:FT|FEET)\b\W{0,6}(?:=|TO|-)?\s*(?:1|ONE|I|L)*\s*I?N?CH", 1)
    return F.when(first != "", F.struct(F.lit(0).alias("rank"), F.try_to_number(first, F.lit("9999")).cast("int").alias("feet"))).when(
        second != "", F.struct(F.when(F.contains(up, F.lit("SHEET")), 2).otherwise(1).alias("rank"), F.try_to_number(second, F.lit("9999")).cast("int").alias("feet"))
    )


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(fold(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def plan_year(name: Column) -> Column:
    found = F.regexp_extract(name, r"(1[5-9][0-9]{2}|20[0-9]{2})", 1)
    return F.when(found != "", found.cast("int"))


def fuzzy_match(label: Column, name: Column) -> Column:
    """Whether a label key is a fragment or a slip of a name key."""
    gap = F.length(name) - F.length(label)
    fragment = (F.startswith(name, label) | F.endswith(name, label)) & (gap <= 2) & (F.length(label) >= 5)
    allowed = F.when(F.least(F.length(label), F.length(name)) >= 9, 2).otherwise(1)
    slip = (F.length(label) >= 6) & (F.abs(gap) <= 2) & (F.levenshtein(label, name) <= allowed)
    return (label != name) & (fragment | slip)


def display_name(name: Column, typ: Column) -> Column:
    """Name and type as a viewer shows them."""
    return F.upper(F.trim(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(typ, F.lit("")))))
