"""Schemas, feature list and parameters of the demand engine.

Everything under "Fixed values" must keep these exact values for results to
match the behaviour this engine reproduces; the rest is our own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (semantics of the demand task; keep as written)
# ---------------------------------------------------------------------------
TARGET_COL = "Demanda_uni_equil"
WEEK_COL = "Semana"
PAIR = ["Cliente_ID", "Producto_ID"]
ID_COLS = ["Semana", "Cliente_ID", "Producto_ID", "Agencia_ID", "Ruta_SAK", "Canal_ID"]

VAL_WEEK = 9

LAG_WEEKS = [1, 2, 3, 4, 5]
ROLLING_WINDOWS = [2, 3, 4]
AGG_GROUP_KEYS = {
    "product": ["Producto_ID"],
    "client": ["Cliente_ID"],
    "route": ["Ruta_SAK"],
    "agency": ["Agencia_ID"],
    "client_product": ["Cliente_ID", "Producto_ID"],
    "route_product": ["Ruta_SAK", "Producto_ID"],
    "agency_product": ["Agencia_ID", "Producto_ID"],
}

# Backoff ladder, most specific first; () is the global mean.
BACKOFF_LEVELS = [
    ("Cliente_ID", "Producto_ID"),
    ("Ruta_SAK", "Producto_ID"),
    ("Agencia_ID", "Producto_ID"),
    ("Producto_ID",),
    ("brand",),
    (),
]

# Boosting parameters.
GBM_PARAMS = {
    "objective": "tweedie",
    "tweedie_variance_power": 1.5,
    "learning_rate": 0.05,
    "num_leaves": 127,
    "min_child_samples": 100,
    "feature_fraction": 0.8,
    "bagging_fraction": 0.8,
    "bagging_freq": 5,
    "lambda_l1": 0.1,
    "lambda_l2": 1.0,
    "seed": 42,
}
GBM_NUM_ROUNDS = 1500
GBM_EARLY_STOPPING = 50
QUANTILE_ALPHAS = (0.1, 0.9)

# Request bounds for scoring.
REQUEST_WEEK_MIN = 3
REQUEST_WEEK_MAX = 15

# Product-name patterns (Python-compatible regexes; see functions/names.py).
WEIGHT_PATTERN = r"(\d+(?:\.\d+)?)\s*(g|kg|ml|l)\b"
PIECES_PATTERN = r"(\d+)\s*p\b"
PROMO_PATTERN = r"promo|oferta|desc|gratis"
UNKNOWN_BRAND = "UNK"
UNKNOWN_STATE = "UNKNOWN"

# Report sizes.
SCATTER_SAMPLE = 50_000
SAMPLE_SEED = 42
ERROR_BINS = 100
DRIFT_BINS = 80
CLIP_PERCENTILE = 0.99
DRIFT_THRESHOLD = 0.05
HIGH_BIAS_FACTOR = 2.0
WORST_SEGMENTS = 20
TOP_FEATURES = 20
CV_MIN_TRAIN_WEEKS = 3
MA_WINDOW = 3

# Input schemas. Unsigned source types widen one step; nothing is narrowed.
SALES_SCHEMA = T.StructType([
    T.StructField("Semana", T.IntegerType()),
    T.StructField("Agencia_ID", T.IntegerType()),
    T.StructField("Canal_ID", T.IntegerType()),
    T.StructField("Ruta_SAK", T.IntegerType()),
    T.StructField("Cliente_ID", T.LongType()),
    T.StructField("Producto_ID", T.IntegerType()),
    T.StructField("Venta_uni_hoy", T.IntegerType()),
    T.StructField("Venta_hoy", T.FloatType()),
    T.StructField("Dev_uni_proxima", T.IntegerType()),
    T.StructField("Dev_proxima", T.FloatType()),
    T.StructField("Demanda_uni_equil", T.IntegerType()),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("Semana", T.IntegerType()),
    T.StructField("Agencia_ID", T.IntegerType()),
    T.StructField("Canal_ID", T.IntegerType()),
    T.StructField("Ruta_SAK", T.IntegerType()),
    T.StructField("Cliente_ID", T.LongType()),
    T.StructField("Producto_ID", T.IntegerType()),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("Producto_ID", T.IntegerType()),
    T.StructField("NombreProducto", T.StringType()),
])

TOWN_SCHEMA = T.StructType([
    T.StructField("Agencia_ID", T.IntegerType()),
    T.StructField("Town", T.StringType()),
    T.StructField("State", T.StringType()),
])

CLIENT_SCHEMA = T.StructType([
    T.StructField("Cliente_ID", T.LongType()),
    T.StructField("NombreCliente", T.StringType()),
])

# ---------------------------------------------------------------------------

# Measures of the target week; never features (they are unknown at scoring).
SALE_MEASURES = ["Venta_uni_hoy", "Venta_hoy", "Dev_uni_proxima", "Dev_proxima"]

LAG_COLS = [f"lag_{k}" for k in LAG_WEEKS]
ROLLING_COLS = [f"rolling_{s}_{w}" for w in ROLLING_WINDOWS for s in ("mean", "std", "median")]
AGG_COLS = [f"{g}_{s}" for g in AGG_GROUP_KEYS for s in ("mean", "std", "count")]
PRODUCT_FEATURE_COLS = ["brand_encoded", "weight_g", "pieces", "has_promo"]

# The fixed feature list, in model order (43 columns).
FEATURE_COLS = (
    LAG_COLS
    + ROLLING_COLS
    + AGG_COLS
    + PRODUCT_FEATURE_COLS
    + ["State_encoded", "backoff_level", "backoff_estimate", "target_semana"]
)
