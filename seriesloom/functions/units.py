"""Packages, units and delivery places in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: How packages spell kilograms, the longest first, and names of bundles.
KILOGRAMS = ["kilogramos", "kilogramo", "kilos", "kilo", "kgs", "kg"]
BUNDLES = ["mazo", "mazos"]


def pack_weight(package: Column) -> Column:
    """Kilograms that a package text states: ``x`` and an amount before a unit of mass (``CAJON X 10,5 KGS``,
    ``x 1 000 kilos``), or an amount right behind one (``bolsa kg 25``); null if it states none."""
    text = F.translate(F.lower(package), ",", ".")
    text = F.regexp_replace(text, r"(?<=\d)\s(?=\d{3}(?![\d.]))", "")  # blanks between thousands
    unit, amount = rf"(?:{'|'.join(KILOGRAMS)})(?![\p{{L}}\d])", r"(\d+(?:\.\d+)?)"
    stated = F.regexp_extract(text, rf"(?<![\p{{L}}\d])x\s*{amount}\s*{unit}", 1)
    behind = F.regexp_extract(text, rf"(?<![\p{{L}}\d]){unit}\.?\s*{amount}(?![\p{{L}}\d])", 1)
    return F.coalesce(F.nullif(stated, F.lit("")), F.nullif(behind, F.lit(""))).try_cast("double")


def is_bundle(package: Column) -> Column:
    """Whether a word of the package names a bundle, whose stated weight proves nothing."""
    return F.arrays_overlap(F.split(F.lower(package), r"[^\p{L}]+"), F.array(*map(F.lit, BUNDLES)))


def price_per_kg(price: Column, unit: Column, kg: Column) -> Column:
    """Price of a kilogram: as it is, or of a package by its weight; null if neither is known."""
    return F.when(unit == "kg", price).when((unit == "bulto") & (kg > 0), price / kg)


def weight_validated(unit: Column, package: Column, kg: Column) -> Column:
    """Whether the weight is certain.  What is sold by the kilogram needs none; of a package it must be positive and
    be stated by the package's own text, too, unless that is a bundle.  What isn't known isn't certain."""
    agrees = F.coalesce((kg > 0) & (pack_weight(package) == kg), F.lit(False))
    return F.coalesce(F.when(unit == "kg", True).when(unit == "bulto", agrees & ~F.coalesce(is_bundle(package), F.lit(False))), F.lit(False))


def conversion_method(unit: Column, kg: Column) -> Column:
    return F.when(unit == "kg", "por kg").when((unit == "bulto") & (kg > 0), "por bulto").otherwise("sin kg")


def delivery_basis(place: Column) -> Column:
    """The last two words of a delivery place, as they stand, where they are "en" and "origen" or "destino"; else empty."""
    two = F.regexp_extract(place, r"((?<!\p{L})\p{L}+\s+\p{L}+)\s*$", 1)
    plain = F.regexp_replace(F.lower(two), r"\s+", " ")
    return F.when(plain.isin("en origen", "en destino"), two).when(place.isNotNull(), "")


def price_consistency(unit_price: Column, selected: Column, total: Column, volume: Column) -> tuple[Column, Column]:
    """(unit price equals the selected price; total agrees with unit price by volume within the
    greater of 1 and one per cent)."""
    return F.abs(unit_price - selected) <= 1e-6, F.abs(unit_price * volume - total) <= F.greatest(F.lit(1.0), 0.01 * F.abs(total))
