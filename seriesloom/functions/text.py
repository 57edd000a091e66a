"""Text keys, cleaning and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their plain forms, place by place.
ACCENTED = "ßáàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "saaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"
# UTF-8 read as Latin-1, spreadsheet errors and words for no value, and connectors.
MOJIBAKE = [("Ã¡", "á"), ("Ã©", "é"), ("Ã\u00ad", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã±", "ñ"), ("Ã¼", "ü"), ("Ã¨", "è"), ("Ãª", "ê"), ("Ã§", "ç"), ("Â°", "°")]
SHEET_ERRORS = ["#REF!", "#N/A", "#DIV/0!", "#VALUE!", "#NAME?", "#NULL!", "#NUM!", "NAN", "NA", "NULL", "NONE", "UNDEFINED"]
CONNECTORS = ["a", "al", "de", "del", "la", "las", "los", "y", "e", "da", "do"]


def fold(text: Column) -> Column:
    """Accents off, lower case."""
    return F.lower(F.translate(text, ACCENTED, PLAIN))


def text_key(text: Column, flavour: str = "spaced") -> Column:
    """``spaced``, ``joined`` or ``upper`` key of letters and digits; ``ascii`` drops the rest of Unicode, too."""
    spaced = F.trim(F.regexp_replace(fold(text), r"[^\p{L}\p{N}]+", " "))
    if flavour == "joined":
        return F.replace(spaced, F.lit(" "), F.lit(""))
    if flavour == "upper":
        return F.upper(spaced)
    if flavour == "ascii":
        return F.trim(F.regexp_replace(fold(text), r"[^a-z0-9]+", " "))
    return spaced


def clean_text(text: Column) -> Column:
    """Repairs misread accents, collapses spaces (hard ones, too); spreadsheet errors, words for no
    value in any case, and empty text become null."""
    text = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    for wrong, right in MOJIBAKE:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(~F.upper(text).isin(*SHEET_ERRORS) & (text != ""), text)


def title_case(text: Column) -> Column:
    """A capital at the begin of each word and behind ``-`` and ``'``; connectors stay in lower case,
    but for the first word."""
    parts = F.regexp_extract_all(F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))), F.lit(r"([ '-]|[^ '-]+)"), 1)
    first = F.array_position(F.transform(parts, lambda x: ~x.isin(" ", "'", "-")), True)
    word = lambda x, i: F.when(x.isin(*CONNECTORS) & (i + 1 != first), x).otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30)))
    return F.array_join(F.transform(parts, word), "")


def classify(text: Column, rules: list[tuple[str, str]], other: str = "otro") -> Column:
    """The label of the first rule whose folded prefix or part occurs; a rule ``^x`` is a prefix."""
    key, out = text_key(text), None
    for part, label in rules:
        hit = key.startswith(part[1:]) if part.startswith("^") else key.contains(part)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(other)
