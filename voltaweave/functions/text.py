"""Keys, names and labels from dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ordered rules from a part of a lower-cased owner's name to its canonical name; the first that fits wins.
OWNER_RULES = [
    ("i-de", "iDE"),
    ("i de ", "iDE"),
    ("iberdrola distribución", "iDE"),
    ("iberdrola distribucion", "iDE"),
    ("ide", "iDE"),
    ("endesa", "Endesa"),
    ("e-distribución", "Endesa"),
    ("edistribucion", "Endesa"),
    ("e distribución", "Endesa"),
    ("ufd", "UFD"),
    ("unión fenosa", "UFD"),
    ("union fenosa", "UFD"),
    ("viesgo", "Viesgo"),
    ("red eléctrica", "REE"),
    ("red electrica", "REE"),
    ("ree", "REE"),
    ("naturgy", "Naturgy"),
]

#: Month names, full.
MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]
SPACE = r"(?U)\s+"


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")


def collapsed(c: Column) -> Column:
    """Lower case, white space runs as one blank, none at the ends: for headers."""
    return stripped(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), SPACE, " "))


def tension_of_last_token(c: Column) -> Column:
    """The last white-space token as a number, or null."""
    token = F.regexp_extract(stripped(c), r"(?U)(\S+)$", 1)
    return F.when(token.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), token.try_cast("double"))


TENSION = r"(?U)\b(\d{2,4})\s*$"


def tension_of_end(c: Column) -> Column:
    """Two to four closing digits that start at a word boundary, as an integer, or null."""
    return F.nullif(F.regexp_extract(stripped(c), TENSION, 1), F.lit("")).try_cast("int")


def without_tension(c: Column) -> Column:
    """The name without :func:`tension_of_end`; the whole name if nothing else is left."""
    return F.coalesce(F.nullif(stripped(F.regexp_replace(stripped(c), TENSION, "")), F.lit("")), stripped(c))


def short_name(explicit: Column, key: Column) -> Column:
    """The explicit name, or the key without its last blank-separated token."""
    return F.coalesce(F.nullif(stripped(explicit), F.lit("")), F.regexp_replace(key, " [^ ]*$", ""))


def all_but_last_token(c: Column) -> Column:
    """The tokens but the last, joined by single blanks; a single token stays."""
    tokens = F.split(stripped(c), SPACE)
    return F.when(F.size(tokens) > 1, F.array_join(F.slice(tokens, 1, F.size(tokens) - 1), " ")).otherwise(stripped(c))


def normal_key(c: Column) -> Column:
    """A key without bracketed parts and with single blanks, for matching."""
    return stripped(F.regexp_replace(F.regexp_replace(c, r"(?U)\s*\([^)]*\)", ""), SPACE, " "))


def title_case(c: Column) -> Column:
    """Every letter that follows no letter in upper case, all others in lower case."""
    letters = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(letters, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 2**30)))), "")


def canonical(c: Column, rules: list[tuple[str, str]] = OWNER_RULES) -> Column:
    """The first rule whose part the lower-cased text contains, else title case; null and empty stay."""
    low, chain = F.lower(c), None
    for part, name in rules:
        chain = F.when(low.contains(part), name) if chain is None else chain.when(low.contains(part), name)
    return F.when(c.isNull() | (c == ""), c).otherwise(title_case(c) if chain is None else chain.otherwise(title_case(c)))


def tension_label(kv: Column) -> Column:
    """Whole tensions without decimals, others as they are; missing or NaN as empty."""
    plain = F.when(kv == F.floor(kv), F.floor(kv).cast("long").cast("string")).otherwise(kv.cast("string"))
    return F.when(kv.isNull() | F.isnan(kv), F.lit("")).otherwise(plain)


def name_and_tension(name: Column, kv: Column) -> Column:
    """The key ``NAME kV``, upper-cased, or the name alone."""
    return F.rtrim(F.concat(F.upper(stripped(name)), F.lit(" "), tension_label(kv)))


def month_number(name: Column, letters: int | None = None) -> Column:
    """The month of a (lower-cased) name, by its first ``letters`` or in full; null if unknown."""
    found = None
    for i, month in enumerate(MONTHS, 1):
        fits = name == (month[:letters] if letters else month)
        found = F.when(fits, i) if found is None else found.when(fits, i)
    return found


def month_inside(name: Column) -> Column:
    """The first month, in calendar order, whose full name the text contains."""
    found = None
    for i, month in enumerate(MONTHS, 1):
        fits = F.lower(name).contains(month)
        found = F.when(fits, i) if found is None else found.when(fits, i)
    return found


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year.cast("int"), month.cast("int"))


def accents_folded(c: Column) -> Column:
    """Upper case without accents, for loose matching of names."""
    return F.translate(F.upper(c), "ÁÀÄÂÉÈËÊÍÌÏÎÓÒÖÔÚÙÜÛÑÇ", "AAAAEEEEIIIIOOOOUUUUNC")
