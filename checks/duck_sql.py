"""DuckDB SQL for every SQL-checkable registered query.

Written from the reference semantics, not from the Spark plans: lags are one
left join per lag, rolling windows filter on the last w observed weeks,
backoff is a join per level, multi-week features are a UNION ALL of single
weeks. Each query is wrapped so columns come out with the declared kinds
(i = BIGINT, d = DOUBLE rounded to 6 places, s = VARCHAR, b = BOOLEAN).
"""

from __future__ import annotations

FEATURE_COLS_ORDER = None  # filled lazily from panelcast.config

BASE_CTES = {
    "demand_events": """
SELECT CAST(least(7, 3 + floor(date_diff('day', TIMESTAMP '2024-01-01', ts)/7)) AS INT) AS Semana,
       CAST(user_id % 5 AS INT) AS Agencia_ID, CAST(user_id % 3 AS INT) AS Canal_ID,
       CAST(user_id % 10 AS INT) AS Ruta_SAK, user_id AS Cliente_ID,
       CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                       WHEN 'signup' THEN 4 ELSE 5 END AS Producto_ID,
       CAST(floor(value) AS BIGINT) AS Demanda_uni_equil
FROM events""",
    "demand_sales": """
SELECT CAST(least(9, 3 + floor(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate)/358)) AS INT) AS Semana,
       CASE WHEN c_nationkey = 24 THEN c_nationkey + 100 ELSE c_nationkey END AS Agencia_ID,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
            WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS Canal_ID,
       l_suppkey AS Ruta_SAK, o_custkey AS Cliente_ID, CASE WHEN l_partkey % 97 = 0 THEN l_partkey + 10000000 ELSE l_partkey END AS Producto_ID,
       CAST(l_quantity AS INT) AS Venta_uni_hoy, l_extendedprice AS Venta_hoy,
       CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) ELSE 0 END AS Dev_uni_proxima,
       CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS Dev_proxima,
       CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS BIGINT) AS Demanda_uni_equil
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey""",
    "products": """
SELECT p_partkey AS Producto_ID,
       concat(p_name, ' ', CASE WHEN p_type='PROMO' THEN 'Promo ' ELSE '' END,
              CAST(p_size AS STRING), 'p ',
              CASE WHEN p_size % 2 = 0 THEN concat(CAST(p_size*10 AS STRING),'g')
                   ELSE concat(CAST(p_size AS STRING),'kg') END,
              ' ', p_brand, ' ', CAST(p_partkey AS STRING)) AS NombreProducto
FROM part""",
    "towns": """
SELECT n_nationkey AS Agencia_ID, n_name AS Town, r_name AS State
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "score_rows": """
SELECT CAST(row_number() OVER (ORDER BY Cliente_ID, Producto_ID, Ruta_SAK, Agencia_ID, Canal_ID) AS INT) AS id,
       10 AS Semana, Agencia_ID, Canal_ID, Ruta_SAK,
       CASE WHEN Cliente_ID % 5 = 0 THEN Cliente_ID + 1000000 ELSE Cliente_ID END AS Cliente_ID,
       Producto_ID
FROM (SELECT DISTINCT Agencia_ID, Canal_ID, Ruta_SAK, Cliente_ID, Producto_ID
      FROM demand_sales WHERE Semana = 9) k""",
    # F1-F4 on the product names.
    "parsed": r"""
SELECT Producto_ID, NombreProducto,
       CASE WHEN len(string_split_regex(trim(NombreProducto), '\s+')) >= 2
            THEN list_extract(string_split_regex(trim(NombreProducto), '\s+'),
                              len(string_split_regex(trim(NombreProducto), '\s+')) - 1)
            ELSE 'UNK' END AS brand,
       COALESCE(
         TRY_CAST(NULLIF(regexp_extract(NombreProducto, '(?i)(\d+(?:\.\d+)?)\s*(g|kg|ml|l)\b', 1), '') AS DOUBLE)
         * CASE WHEN lower(regexp_extract(NombreProducto, '(?i)(\d+(?:\.\d+)?)\s*(g|kg|ml|l)\b', 2)) IN ('kg', 'l')
                THEN 1000.0 ELSE 1.0 END, 0.0) AS weight_g,
       COALESCE(TRY_CAST(NULLIF(regexp_extract(NombreProducto, '(?i)(\d+)\s*p\b', 1), '') AS BIGINT), 1) AS pieces,
       CASE WHEN regexp_matches(NombreProducto, '(?i)promo|oferta|desc|gratis') THEN 1 ELSE 0 END AS has_promo
FROM products""",
    "brand_enc": """
SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS brand_encoded
FROM (SELECT DISTINCT coalesce(brand, 'UNK') AS brand FROM parsed) b""",
    "state_map": """
SELECT State, row_number() OVER (ORDER BY State) - 1 AS State_encoded
FROM (SELECT DISTINCT coalesce(t.State, 'UNKNOWN') AS State
      FROM (SELECT DISTINCT Agencia_ID FROM demand_sales) a
      LEFT JOIN towns t ON a.Agencia_ID = t.Agencia_ID) s""",
    "processed": """
SELECT s.*, p.brand, p.weight_g, p.pieces, p.has_promo, m.State_encoded
FROM demand_sales s
LEFT JOIN parsed p ON s.Producto_ID = p.Producto_ID
LEFT JOIN towns t ON s.Agencia_ID = t.Agencia_ID
LEFT JOIN state_map m ON coalesce(t.State, 'UNKNOWN') = m.State""",
    "prod_feats": """
SELECT p.Producto_ID,
       coalesce(e.brand_encoded, (SELECT max(brand_encoded) + 1 FROM brand_enc)) AS brand_encoded,
       p.weight_g, p.pieces, p.has_promo
FROM parsed p LEFT JOIN brand_enc e ON coalesce(p.brand, 'UNK') = e.brand""",
}

CTE_ORDER = ["demand_events", "demand_sales", "products", "towns", "score_rows", "parsed",
             "brand_enc", "state_map", "processed", "prod_feats"]

AGG_GROUP_KEYS = {
    "product": ["Producto_ID"],
    "client": ["Cliente_ID"],
    "route": ["Ruta_SAK"],
    "agency": ["Agencia_ID"],
    "client_product": ["Cliente_ID", "Producto_ID"],
    "route_product": ["Ruta_SAK", "Producto_ID"],
    "agency_product": ["Agencia_ID", "Producto_ID"],
}
LEVEL_AGGS = ["client_product", "route_product", "agency_product", "product"]
ID_COLS = ["Semana", "Cliente_ID", "Producto_ID", "Agencia_ID", "Ruta_SAK", "Canal_ID"]
Y = "Demanda_uni_equil"


def with_ctes(extra: list[tuple[str, str]], body: str) -> str:
    parts = [f"{n} AS ({BASE_CTES[n]})" for n in CTE_ORDER]
    parts += [f"{n} AS ({q})" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


def wrap(sql_body: str, shape: list[tuple[str, str]], order_by: str | None = None) -> str:
    """Outer select casting each column to its declared kind."""
    def cast(c: str, k: str) -> str:
        q = f'"{c}"'
        if k == "i":
            return f"CAST({q} AS BIGINT) AS {q}"
        if k == "d":
            return f"ROUND(CAST({q} AS DOUBLE), 6) + 0.0 AS {q}"
        if k == "s":
            return f"CAST({q} AS VARCHAR) AS {q}"
        if k == "b":
            return f"CAST({q} AS BOOLEAN) AS {q}"
        raise ValueError(k)
    sel = ", ".join(cast(c, k) for c, k in shape)
    tail = f" ORDER BY {order_by}" if order_by else ""
    return f"SELECT {sel} FROM (\n{sql_body}\n) __q{tail}"


# --- feature SQL ----------------------------------------------------------

def lag_sql(src: str, s: int, prefix: str) -> list[tuple[str, str]]:
    """CTEs for X1 at week s: {prefix}_lag with pair + 14 columns."""
    ctes = [(f"{prefix}_wk", f"SELECT Cliente_ID, Producto_ID, Semana, sum({Y}) AS y "
                             f"FROM {src} WHERE Semana < {s} GROUP BY Cliente_ID, Producto_ID, Semana"),
            (f"{prefix}_weeks", f"SELECT DISTINCT Semana FROM {prefix}_wk")]
    sel = ["p.Cliente_ID", "p.Producto_ID"]
    joins = []
    for k in range(1, 6):
        ctes.append((f"{prefix}_l{k}", f"SELECT Cliente_ID, Producto_ID, y AS lag_{k} FROM {prefix}_wk "
                                       f"WHERE Semana = {s - k}"))
        joins.append(f"LEFT JOIN {prefix}_l{k} l{k} ON p.Cliente_ID = l{k}.Cliente_ID "
                     f"AND p.Producto_ID = l{k}.Producto_ID")
        sel.append(f"CAST(l{k}.lag_{k} AS DOUBLE) AS lag_{k}")
    for w in (2, 3, 4):
        ctes.append((f"{prefix}_r{w}",
                     f"SELECT Cliente_ID, Producto_ID, avg(y) AS m, stddev_samp(y) AS sd, "
                     f"median(y) AS md FROM {prefix}_wk WHERE Semana IN "
                     f"(SELECT Semana FROM {prefix}_weeks ORDER BY Semana DESC LIMIT {w}) "
                     f"GROUP BY Cliente_ID, Producto_ID"))
        joins.append(f"LEFT JOIN {prefix}_r{w} r{w} ON p.Cliente_ID = r{w}.Cliente_ID "
                     f"AND p.Producto_ID = r{w}.Producto_ID")
        sel += [f"r{w}.m AS rolling_mean_{w}", f"coalesce(r{w}.sd, 0) AS rolling_std_{w}",
                f"CAST(r{w}.md AS DOUBLE) AS rolling_median_{w}"]
    ctes.append((f"{prefix}_lag",
                 f"SELECT {', '.join(sel)} FROM (SELECT DISTINCT Cliente_ID, Producto_ID FROM {prefix}_wk) p "
                 + " ".join(joins)))
    return ctes


def agg_sql(src: str, s: int, name: str) -> str:
    keys = ", ".join(AGG_GROUP_KEYS[name])
    return (f"SELECT {keys}, avg({Y}) AS {name}_mean, coalesce(stddev_samp({Y}), 0) AS {name}_std, "
            f"count({Y}) AS {name}_count FROM {src} WHERE Semana < {s} GROUP BY {keys}")


LAG_NAMES = [f"lag_{k}" for k in range(1, 6)]
ROLL_NAMES = [f"rolling_{st}_{w}" for w in (2, 3, 4) for st in ("mean", "std", "median")]
AGG_NAMES = [f"{g}_{st}" for g in AGG_GROUP_KEYS for st in ("mean", "std", "count")]
FEATURES = (LAG_NAMES + ROLL_NAMES + AGG_NAMES + ["brand_encoded", "weight_g", "pieces", "has_promo"]
            + ["State_encoded", "backoff_level", "backoff_estimate", "target_semana"])


def feature_matrix_ctes(s: int, include_target: bool = True) -> tuple[list[tuple[str, str]], str]:
    """CTEs + final SELECT text (no WITH) of X5 at week s on ``processed``."""
    p = f"f{s}"
    ctes = lag_sql("processed", s, p)
    for name in AGG_GROUP_KEYS:
        ctes.append((f"{p}_{name}", agg_sql("processed", s, name)))
    ctes.append((f"{p}_brand", f"SELECT brand, avg({Y}) AS b FROM processed WHERE Semana < {s} "
                               f"AND brand IS NOT NULL GROUP BY brand"))
    ctes.append((f"{p}_glob", f"SELECT avg({Y}) AS g FROM processed WHERE Semana < {s}"))
    joins = [f"LEFT JOIN {p}_lag lg ON t.Cliente_ID = lg.Cliente_ID AND t.Producto_ID = lg.Producto_ID"]
    for name, keys in AGG_GROUP_KEYS.items():
        on = " AND ".join(f"t.{k} = a_{name}.{k}" for k in keys)
        joins.append(f"LEFT JOIN {p}_{name} a_{name} ON {on}")
    joins.append("LEFT JOIN prod_feats pf ON t.Producto_ID = pf.Producto_ID")
    joins.append("LEFT JOIN parsed pb ON t.Producto_ID = pb.Producto_ID")
    joins.append(f"LEFT JOIN {p}_brand bb ON coalesce(pb.brand, 'UNK') = bb.brand")
    joins.append(f"CROSS JOIN {p}_glob gg")
    lv = [f"a_{n}.{n}_mean" for n in LEVEL_AGGS] + ["bb.b"]
    level = "CASE " + " ".join(f"WHEN {c} IS NOT NULL THEN {i}" for i, c in enumerate(lv)) + " ELSE 5 END"
    est = f"coalesce({', '.join(lv)}, gg.g)"
    feat_expr = {c: f"lg.{c}" for c in LAG_NAMES + ROLL_NAMES}
    for name in AGG_GROUP_KEYS:
        for st in ("mean", "std", "count"):
            feat_expr[f"{name}_{st}"] = f"a_{name}.{name}_{st}"
    for c in ("brand_encoded", "weight_g", "pieces", "has_promo"):
        feat_expr[c] = f"pf.{c}"
    feat_expr["State_encoded"] = "t.State_encoded"
    feat_expr["backoff_level"] = level
    feat_expr["backoff_estimate"] = est
    feat_expr["target_semana"] = str(s)
    head = [f"t.{c}" for c in ID_COLS] + ([f"t.{Y}"] if include_target else [])
    sel = head + [f"coalesce(CAST({feat_expr[c]} AS DOUBLE), 0.0) AS {c}" for c in FEATURES]
    body = (f"SELECT {', '.join(sel)} FROM processed t " + " ".join(joins)
            + f" WHERE t.Semana = {s}")
    return ctes, body


def lag1_sql(src: str, target: str, s: int, prefix: str) -> tuple[list[tuple[str, str]], str]:
    """M1 at week s: CTEs + select of target.* and prediction."""
    ctes = [(f"{prefix}_last", f"SELECT Cliente_ID, Producto_ID, sum({Y}) AS last FROM {src} "
                               f"WHERE Semana = {s - 1} GROUP BY Cliente_ID, Producto_ID"),
            (f"{prefix}_pm", f"SELECT Producto_ID, avg({Y}) AS pm FROM {src} WHERE Semana < {s} "
                             f"GROUP BY Producto_ID"),
            (f"{prefix}_gm", f"SELECT avg({Y}) AS gm FROM {src} WHERE Semana < {s}")]
    body = (f"SELECT t.*, CASE WHEN coalesce(l.last, pm.pm, gm.gm) IS NULL THEN NULL "
            f"ELSE greatest(CAST(coalesce(l.last, pm.pm, gm.gm) AS DOUBLE), 0.0) END AS prediction "
            f"FROM {target} t LEFT JOIN {prefix}_last l ON t.Cliente_ID = l.Cliente_ID "
            f"AND t.Producto_ID = l.Producto_ID LEFT JOIN {prefix}_pm pm ON t.Producto_ID = pm.Producto_ID "
            f"CROSS JOIN {prefix}_gm gm")
    return ctes, body


def ma_sql(src: str, target: str, s: int, prefix: str, window: int = 3) -> tuple[list[tuple[str, str]], str]:
    ctes = [(f"{prefix}_wks", f"SELECT Semana FROM (SELECT DISTINCT Semana FROM {src} WHERE Semana < {s}) "
                              f"ORDER BY Semana DESC LIMIT {window}"),
            (f"{prefix}_ma", f"SELECT Cliente_ID, Producto_ID, avg({Y}) AS ma FROM {src} "
                             f"WHERE Semana IN (SELECT Semana FROM {prefix}_wks) "
                             f"GROUP BY Cliente_ID, Producto_ID"),
            (f"{prefix}_gm", f"SELECT avg({Y}) AS gm FROM {src} WHERE Semana < {s}")]
    body = (f"SELECT t.*, CASE WHEN coalesce(m.ma, gm.gm) IS NULL THEN NULL "
            f"ELSE greatest(CAST(coalesce(m.ma, gm.gm) AS DOUBLE), 0.0) END AS prediction "
            f"FROM {target} t LEFT JOIN {prefix}_ma m ON t.Cliente_ID = m.Cliente_ID "
            f"AND t.Producto_ID = m.Producto_ID CROSS JOIN {prefix}_gm gm")
    return ctes, body


def metrics_select(y: str, p: str) -> str:
    return (f"sqrt(avg(power(CAST({y} AS DOUBLE) - {p}, 2))) AS rmse, "
            f"avg(abs(CAST({y} AS DOUBLE) - {p})) AS mae, "
            f"avg({p} - CAST({y} AS DOUBLE)) AS bias, "
            f"sqrt(avg(power(ln(1 + greatest({p}, 0.0)) - ln(1 + greatest(CAST({y} AS DOUBLE), 0.0)), 2))) AS rmsle")


def histogram_sql(src: str, col: str, bins: int, prefix: str) -> tuple[list[tuple[str, str]], str]:
    """Equal-width histogram of ``col`` in ``src`` with all bins listed."""
    ctes = [(f"{prefix}_x", f"SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL"),
            (f"{prefix}_r0", f"SELECT min(x) AS lo, max(x) AS hi FROM {prefix}_x"),
            (f"{prefix}_r", f"SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, "
                            f"CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM {prefix}_r0"),
            # explicit edges; every value is joined to the edges around it
            (f"{prefix}_e", f"SELECT CAST(range AS INT) AS bin, lo + range * ((hi - lo) / {float(bins)}) AS a, "
                            f"CASE WHEN range = {bins - 1} THEN hi ELSE lo + (range + 1) * ((hi - lo) / {float(bins)}) END AS b "
                            f"FROM range({bins}), {prefix}_r"),
            (f"{prefix}_v", f"SELECT x, count(*) AS n FROM {prefix}_x GROUP BY x"),
            (f"{prefix}_c", f"SELECT e.bin, sum(n) AS n FROM {prefix}_v v JOIN {prefix}_e e ON v.x >= e.a "
                            f"AND (v.x < e.b OR (e.bin = {bins - 1} AND v.x = e.b)) GROUP BY 1")]
    body = (f"SELECT e.bin, e.a AS lo, e.b AS hi, coalesce(c.n, 0) AS n "
            f"FROM {prefix}_e e LEFT JOIN {prefix}_c c ON e.bin = c.bin")
    return ctes, body


def quantile_sql(src: str, col: str, q: float) -> str:
    """Scalar subquery: NumPy-linear q-quantile."""
    return f"(SELECT quantile_cont({col}, {q}) FROM {src})"


def ks_pvalue_sql(d: str, n1: str, n2: str) -> str:
    lam = (f"((sqrt(({n1})*({n2})/(({n1})+({n2}))) + 0.12 + 0.11/sqrt(({n1})*({n2})/(({n1})+({n2})))) * ({d}))")
    series = (f"(SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * {lam} * {lam})) "
              f"FROM range(1, 101) t(k))")
    return f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(greatest(2.0 * {series}, 0.0), 1.0) END"
