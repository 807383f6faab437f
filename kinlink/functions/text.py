"""Text normalization as column expressions; only the Unicode fold leaves the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kinlink import config as C

#: Letters that decomposition leaves as they are, and their usual Latin spelling.
LETTERS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "€": "EUR", "№": "No",
}
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюя", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch - y - e iu ia".split(), strict=True))
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(), strict=True))


def _tables() -> dict[int, str]:
    out = dict(LETTERS)
    for table in (CYRILLIC, GREEK):
        for k, v in table.items():
            out[k] = v.strip("-")
            if k.upper() != k:
                out[k.upper()] = v.strip("-").capitalize()
    # the Indic blocks share one layout of 128 places; consonants carry an inherent a
    rows = {0x05: "a aa i ii u uu r l e e e ai o o o au".split(), 0x15: "k kh g gh ng c ch j jh ny tt tth dd ddh nn t th d dh n n p ph b bh m y r rr l ll lll v sh ss s h".split(), 0x3E: "aa i ii u uu r rr e e e ai o o o au".split()}
    for block in range(0x0900, 0x0D80, 0x80):
        for at, names in rows.items():
            for i, name in enumerate(names):
                out[chr(block + at + i)] = name + ("a" if at == 0x15 else "")
        out[chr(block + 2)], out[chr(block + 3)], out[chr(block + 0x4D)] = "m", "h", ""
        for i in range(10):
            out[chr(block + 0x66 + i)] = str(i)
    return {ord(k): v for k, v in out.items()}


_TABLE = _tables()


def fold_text(text: str | None) -> str:
    """Compatibility form, then ASCII spelling of Latin, Cyrillic, Greek and Indic letters; other scripts stay."""
    if not text:
        return ""
    if text.isascii():
        return text
    s = unicodedata.normalize("NFKC", text)
    out: list[str] = []
    for ch in s:
        name = _TABLE.get(ord(ch))
        if name is None:
            base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
            name = "".join(_TABLE.get(ord(c), c) for c in base)
        elif 0x0900 <= ord(ch) < 0x0D80 and out and out[-1].endswith("a") and (ord(ch) & 0x7F) in range(0x3E, 0x4E):
            out[-1] = out[-1][:-1]  # a vowel sign or virama replaces the inherent vowel
        out.append(name)
    return "".join(out)


@F.pandas_udf(StringType())
def _fold(texts: pd.Series) -> pd.Series:
    return texts if texts.isna().all() else texts.map(fold_text, na_action="ignore")


def fold(c: Column) -> Column:
    """fold_text over Arrow batches. ASCII texts are their own fold and stay in the JVM: batches carry nulls for them."""
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, c).otherwise(F.coalesce(_fold(F.when(~plain, c)), F.lit("")))


def clean_basic(c: Column, folded: bool = False) -> Column:
    """Fold, drop dots of acronyms, lower case, & and + to and, other signs to blanks, blanks collapsed."""
    s = F.coalesce(c, F.lit("")) if folded else fold(F.coalesce(c, F.lit("")))
    s = F.lower(F.when(F.contains(s, F.lit(".")), F.regexp_replace(s, C.ACRONYM_DOT, "")).otherwise(s))
    s = F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" and "))
    # white space is no word sign either; Unicode classes are slow and only non-ASCII texts need them
    ascii_only = F.octet_length(s) == F.length(s)
    return F.trim(F.when(ascii_only, F.regexp_replace(s, r"[^0-9A-Za-z_]+", " ")).otherwise(F.regexp_replace(s, r"(?U)\W+", " ")))


def _alternatives(suffixes: dict[str, str]) -> str:
    return "|".join(s for s in sorted(suffixes, key=lambda s: -len(s)))


def _lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value, or null."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def legal_suffix(name: Column, suffixes: dict[str, str] | None = None) -> tuple[Column, Column]:
    """(core, canonical suffix): at most one suffix goes from the front, then one from the end; the front's is named."""
    table = suffixes or C.LEGAL_SUFFIXES
    every = _alternatives(table)
    front, back = rf"^({every})\b\s*", rf"\s*\b({every})$"
    lead = F.regexp_extract(name, front, 1)
    rest = F.trim(F.regexp_replace(name, front, ""))
    tail = F.regexp_extract(rest, back, 1)
    core = F.trim(F.regexp_replace(rest, back, ""))
    found = F.coalesce(_lookup(table, F.when(lead != "", lead).otherwise(tail)), F.lit(""))
    return F.when(core == "", name).otherwise(core), found


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, r"\s+"), "")


def expand_address(c: Column, table: dict[str, str] | None = None, street: bool = False) -> Column:
    """Each abbreviated word spelled out; "st" only if street is set."""
    full = dict(table or C.ADDRESS_WORDS) | ({"st": "street"} if street else {})
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(_lookup(full, w), w)), " ")


def postal_code(address: Column, country: Column) -> Column:
    """First postal code of a raw address, in the country's form; other countries: six digits, else five."""
    up = F.upper(F.trim(country))
    india, us, france = (F.regexp_extract(address, p, 1) for p in (C.POSTAL_INDIA, C.POSTAL_US, C.POSTAL_FRANCE))
    return F.when(up == "INDIA", india).when(up == "US", us).when(up == "FRANCE", france).when(india != "", india).otherwise(us)


def house_number(address: Column) -> Column:
    """House number of a raw address: after a prefix, at the front, or before a street word."""
    s = F.trim(address)
    tight = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s*-\s*", "-"))
    words = tokens(F.regexp_extract(s, C.HOUSE_PREFIXED, 1))
    front, middle = tight(F.regexp_extract(s, C.HOUSE_LEADING, 1)), tight(F.regexp_extract(s, C.HOUSE_BEFORE_STREET, 1))
    prefixed = (F.size(words) > 0) & (F.length(F.get(words, 0)) <= 10)
    return F.when(prefixed, F.lower(F.array_join(F.slice(words, 1, 2), " "))).when((front != "") & (F.length(front) <= 15), front).otherwise(middle)


def numeric_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\b\d+\b"), 0)


def normalize_country(c: Column) -> Column:
    """Known spellings to one name; others in title case, or in capitals up to three letters; null and empty: UNKNOWN."""
    s = F.trim(c)
    out = F.when(c.isNull() | (c == ""), "UNKNOWN")
    for name, said in C.COUNTRIES.items():
        out = out.when(F.lower(s).isin(said), name)
    return out.when(F.length(s) > 3, F.initcap(s)).otherwise(F.upper(s))


def signature(words: Column) -> Column:
    """Sorted informative words (no stopword, two letters or more), or all words if none is; repeats stay."""
    told = F.filter(words, lambda w: ~w.isin(C.STOPWORDS) & (F.length(w) > 1))
    return F.array_join(F.array_sort(F.when(F.size(told) > 0, told).otherwise(words)), " ")


def char_ngrams(c: Column, low: int = 2, high: int = 4) -> Column:
    """All n-grams of the text with a blank at each side, shorter ones first."""
    s = F.concat(F.lit(" "), F.trim(c), F.lit(" "))
    parts = [_grams(s, n) for n in range(low, high + 1)]
    return F.when(F.trim(c) == "", F.array().cast("array<string>")).otherwise(F.concat(*parts))


def _grams(s: Column, n: int) -> Column:
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(n)))
    return F.when(F.length(s) >= n, every).otherwise(F.array().cast("array<string>"))


def gram_set(s: Column, n: int) -> Column:
    """Distinct n-grams; a shorter text is its own gram, an empty one has none."""
    return F.when(s == "", F.array().cast("array<string>")).when(F.length(s) < n, F.array(s)).otherwise(F.array_distinct(_grams(s, n)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones: 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)
