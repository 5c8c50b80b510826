"""Views that bring the driver's star-schema tables into the engine's shape.

``demand_events`` is a dense panel (weeks 3..7), ``demand_sales`` a sparse
one (periods 3..9). ``products`` and ``towns`` are the dimensions, whole; so
that unmatched keys occur, sales of part keys divisible by 97 and of nation 24
get keys that no dimension row has. ``score_rows`` are the week-9 keys moved to week 10.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import with_dense_ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days_since(col: str, day: str):
    return F.datediff(F.col(col).cast("date"), F.lit(day).cast("date"))


def demand_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    dd = _days_since("ts", "2024-01-01")
    return ev.select(
        F.least(F.lit(7), 3 + F.floor(dd / 7)).cast("int").alias("Semana"),
        (F.col("user_id") % 5).cast("int").alias("Agencia_ID"),
        (F.col("user_id") % 3).cast("int").alias("Canal_ID"),
        (F.col("user_id") % 10).cast("int").alias("Ruta_SAK"),
        F.col("user_id").alias("Cliente_ID"),
        F.when(F.col("event_type") == "view", 1)
         .when(F.col("event_type") == "click", 2)
         .when(F.col("event_type") == "purchase", 3)
         .when(F.col("event_type") == "signup", 4)
         .otherwise(5).alias("Producto_ID"),
        F.floor("value").cast("bigint").alias("Demanda_uni_equil"),
    )


def demand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # Orders meet their customers first, so the lines, by far the most rows,
    # are shuffled once, whatever the sizes.
    oc = od.join(cu, od.o_custkey == cu.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    dd = _days_since("l_shipdate", "1995-01-01")
    returned = F.col("l_returnflag") == "R"
    seg = F.col("c_mktsegment")
    return j.select(
        F.least(F.lit(9), 3 + F.floor(dd / 358)).cast("int").alias("Semana"),
        F.when(F.col("c_nationkey") == 24, F.col("c_nationkey") + 100)
         .otherwise(F.col("c_nationkey")).alias("Agencia_ID"),
        F.when(seg == "AUTOMOBILE", 1).when(seg == "BUILDING", 2)
         .when(seg == "FURNITURE", 3).when(seg == "HOUSEHOLD", 4)
         .otherwise(5).alias("Canal_ID"),
        F.col("l_suppkey").alias("Ruta_SAK"),
        F.col("o_custkey").alias("Cliente_ID"),
        F.when(F.col("l_partkey") % 97 == 0, F.col("l_partkey") + 10_000_000)
         .otherwise(F.col("l_partkey")).alias("Producto_ID"),
        F.col("l_quantity").cast("int").alias("Venta_uni_hoy"),
        F.col("l_extendedprice").alias("Venta_hoy"),
        F.when(returned, F.col("l_quantity").cast("int")).otherwise(0).alias("Dev_uni_proxima"),
        F.when(returned, F.col("l_extendedprice")).otherwise(F.lit(0.0)).alias("Dev_proxima"),
        F.when(returned, F.lit(0.0)).otherwise(F.col("l_quantity"))
         .cast("bigint").alias("Demanda_uni_equil"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    name = F.concat(
        F.col("p_name"), F.lit(" "),
        F.when(F.col("p_type") == "PROMO", F.lit("Promo ")).otherwise(F.lit("")),
        size.cast("string"), F.lit("p "),
        F.when(size % 2 == 0, F.concat((size * 10).cast("string"), F.lit("g")))
         .otherwise(F.concat(size.cast("string"), F.lit("kg"))),
        F.lit(" "), F.col("p_brand"), F.lit(" "), F.col("p_partkey").cast("string"))
    return p.select(F.col("p_partkey").alias("Producto_ID"), name.alias("NombreProducto"))


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").alias("Agencia_ID"),
                     F.col("n_name").alias("Town"), F.col("r_name").alias("State")))


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Agencia_ID", "Canal_ID", "Ruta_SAK", "Cliente_ID", "Producto_ID"]
    k = demand_sales(spark, sf_dir).where(F.col("Semana") == 9).select(*keys).distinct()
    ided = with_dense_ids(k, ["Cliente_ID", "Producto_ID", "Ruta_SAK", "Agencia_ID", "Canal_ID"],
                          "id")
    client = F.col("Cliente_ID")
    return ided.select(
        F.col("id").cast("int").alias("id"),
        F.lit(10).alias("Semana"),
        "Agencia_ID", "Canal_ID", "Ruta_SAK",
        F.when(client % 5 == 0, client + 1000000).otherwise(client).alias("Cliente_ID"),
        "Producto_ID",
    )


_MATERIALIZED: dict = {}
VIEWS = {"demand_events": demand_events, "demand_sales": demand_sales, "products": products,
         "towns": towns, "score_rows": score_rows}


def materialized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view written once per session to the scratch folder and read
    back, as an input table would be: later plans scan parquet instead of
    re-running the view's joins in every branch."""
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _MATERIALIZED.get(key)
    if path is None:
        path = scratch_path(spark, f"view-{name}")
        VIEWS[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)
