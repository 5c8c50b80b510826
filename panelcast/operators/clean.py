"""Preprocessing: product metadata, encodings and the enriched fact table.

F7 product metadata, F6 brand encoding, F5 state encoding, J1/J2 dimension
joins and M12 (the preprocessing job body). Dimension tables are small and
are broadcast behind a row-count check; the fact table is never shuffled by
these joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import UNKNOWN_BRAND, UNKNOWN_STATE
from ..functions.encoding import apply_encoding, fit_encoding
from ..functions.names import enrich_products
from .joins import broadcast_if_small

PRODUCT_ATTRS = ["brand", "weight_g", "pieces", "has_promo"]


def product_metadata(products: DataFrame) -> DataFrame:
    """products plus parsed brand, weight_g, pieces, has_promo."""
    return enrich_products(products)


def brand_map(meta: DataFrame) -> DataFrame:
    return meta.select("Producto_ID", "brand")


def brand_encoding(meta: DataFrame) -> DataFrame:
    """(brand, brand_encoded) over the product table's brands, sorted."""
    b = meta.select(F.coalesce(F.col("brand"), F.lit(UNKNOWN_BRAND)).alias("brand"))
    return fit_encoding(b, "brand", "brand_encoded")


def agency_states(sales: DataFrame, towns: DataFrame) -> DataFrame:
    """Distinct agencies of the facts with their State ("UNKNOWN" if absent)."""
    ag = sales.select("Agencia_ID").distinct()
    return (ag.join(broadcast_if_small(towns.select("Agencia_ID", "State")), "Agencia_ID", "left")
              .select("Agencia_ID",
                      F.coalesce(F.col("State"), F.lit(UNKNOWN_STATE)).alias("State")))


def state_encoding(sales: DataFrame, towns: DataFrame) -> DataFrame:
    """(State, State_encoded) over the states that occur in the facts."""
    return fit_encoding(agency_states(sales, towns), "State", "State_encoded")


def state_codes(towns: DataFrame, state_map: DataFrame) -> DataFrame:
    """(Agencia_ID, State_encoded) per known town (agency)."""
    return (towns.select("Agencia_ID", "State")
                 .join(broadcast_if_small(state_map), "State", "left")
                 .select("Agencia_ID", "State_encoded"))


def attach_state(df: DataFrame, towns: DataFrame, state_map: DataFrame) -> DataFrame:
    """Left-join State_encoded by agency; unknown agencies get the code of
    "UNKNOWN" (null when that state was never fitted)."""
    base = df.drop("State_encoded") if "State_encoded" in df.columns else df
    t = broadcast_if_small(towns.select("Agencia_ID", "State"))
    out = (base.join(t, "Agencia_ID", "left")
               .withColumn("State", F.coalesce(F.col("State"), F.lit(UNKNOWN_STATE)))
               .join(broadcast_if_small(state_map), "State", "left"))
    return out.drop("State")


def preprocess(sales: DataFrame, meta: DataFrame, towns: DataFrame,
               state_map: DataFrame | None = None) -> DataFrame:
    """M12 body: facts + product attributes + State_encoded (Town/State dropped).

    Facts with an unknown product keep null attributes; an unknown agency
    gets State "UNKNOWN". Product attributes already on the facts are
    replaced, never duplicated.
    """
    if state_map is None:
        state_map = state_encoding(sales, towns)
    base = sales.drop(*[c for c in PRODUCT_ATTRS + ["NombreProducto", "State_encoded"]
                        if c in sales.columns])
    attrs = broadcast_if_small(meta.select("Producto_ID", *PRODUCT_ATTRS))
    out = base.join(attrs, "Producto_ID", "left")
    out = attach_state(out, towns, state_map)
    return out.select(*base.columns, *PRODUCT_ATTRS, "State_encoded")


def product_features(meta: DataFrame, encoding: DataFrame) -> DataFrame:
    """(Producto_ID, brand_encoded, weight_g, pieces, has_promo).

    A brand missing from the encoding gets max code + 1.
    """
    m = meta.select("Producto_ID", F.coalesce(F.col("brand"), F.lit(UNKNOWN_BRAND)).alias("brand"),
                    "weight_g", "pieces", "has_promo")
    enc = apply_encoding(m, "brand", encoding, "brand_encoded")
    return enc.select("Producto_ID", F.col("brand_encoded").cast("long"),
                      F.col("weight_g").cast("double"), F.col("pieces").cast("long"),
                      F.col("has_promo").cast("long"))
