"""Product-name parsing as native column expressions.

Python's ``\\d \\s \\b`` are Unicode-aware and Java's are ASCII by default, so
every pattern carries ``(?U)`` (UNICODE_CHARACTER_CLASS); ``(?i)`` gives the
case-insensitive match. Everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PIECES_PATTERN, PROMO_PATTERN, UNKNOWN_BRAND, WEIGHT_PATTERN


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def brand(name) -> Column:
    """Second-to-last whitespace token of the stripped name, else 'UNK'."""
    stripped = F.regexp_replace(_c(name), r"(?U)^\s+|\s+$", "")
    toks = F.split(stripped, r"(?U)\s+")
    # "".split() has no tokens; Spark's split of "" gives [""], so size<2 too.
    return F.when(F.size(toks) >= 2, F.element_at(toks, -2)).otherwise(F.lit(UNKNOWN_BRAND))


def weight_g(name) -> Column:
    """First ``number unit`` (g, kg, ml, l); kg and l times 1000; else 0.0."""
    pat = "(?iU)" + WEIGHT_PATTERN
    num = F.nullif(F.regexp_extract(_c(name), pat, 1), F.lit(""))
    unit = F.lower(F.regexp_extract(_c(name), pat, 2))
    val = num.try_cast("double")
    scaled = F.when(unit.isin("kg", "l"), val * 1000.0).otherwise(val)
    return F.coalesce(scaled, F.lit(0.0))


def pieces(name) -> Column:
    """First ``(digits) p`` count, else 1."""
    pat = "(?iU)" + PIECES_PATTERN
    num = F.nullif(F.regexp_extract(_c(name), pat, 1), F.lit(""))
    return F.coalesce(num.try_cast("bigint"), F.lit(1).cast("bigint"))


def has_promo(name) -> Column:
    """1 when the name contains promo/oferta/desc/gratis anywhere, else 0."""
    return F.when(_c(name).rlike("(?i)" + PROMO_PATTERN), 1).otherwise(0)


def enrich_products(products: DataFrame, name_col: str = "NombreProducto") -> DataFrame:
    """Product table plus brand, weight_g, pieces, has_promo (one projection)."""
    return products.select(
        "*",
        brand(name_col).alias("brand"),
        weight_g(name_col).alias("weight_g"),
        pieces(name_col).alias("pieces"),
        has_promo(name_col).alias("has_promo"),
    )
