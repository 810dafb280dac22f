"""Test panels derived (by Spark jobs) from the TPC-H style tables.

The supplied tables hold no retail panel, so one is derived from them:
``lineitem`` joined to ``part``, ``supplier``, ``nation`` and ``region``, grouped by
(nation, brand, ship day). The key is unique by construction. Rows grow with
``lineitem`` up to 25 nations x 25 brands x some 2,500 days, and series stop at 625;
``line_items`` and the requests grow with their tables without end. Money is aggregated as integer cents (and the discount in
basis points), so sums are order-free and the text form of every number is exact and
identical in any SQL engine.

* ``demand_panel_raw`` -- the 16 raw columns as text (what a header CSV gives), with
  malformed ``Inventory Level`` values, plus ``Date_bad`` (malformed dates) for the date parser.
* ``demand_panel`` -- the same rows typed (dates and doubles), without the malformed text.
* ``forecast_requests`` -- one JSON request body per order, with invalid variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.spec import RAW_COLUMN_ORDER


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: Column) -> Column:
    return F.round(c * F.lit(100)).cast("bigint")


def _half_up_div(num: str, den: str) -> Column:
    """Integer division of two bigint columns, rounded half up (non-negative operands)."""
    return F.expr(f"(2 * {num} + {den}) div (2 * {den})")


def _fixed_text(units: str, scale: int) -> Column:
    """Exact decimal text of ``units / 10**scale`` (non-negative), e.g. 208528, 2 -> '2085.28'."""
    base = 10**scale
    whole = F.expr(f"{units} div {base}").cast("string")
    frac = F.lpad(F.expr(f"pmod({units}, {base})").cast("string"), scale, "0")
    return F.concat(whole, F.lit("."), frac)


def _panel_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # part and supplier grow with the scale factor: the planner picks the join strategy
    # from their size (AQE turns a small side into a broadcast at run time). Region is
    # joined after the aggregation (a nation determines its region).
    j = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .join(nation, supp.s_nationkey == nation.n_nationkey)
    )
    # Level 1: numeric measures only, so it is a hash aggregate with partial aggregation
    # before the shuffle (a hot nation/brand/day costs one row per map task).
    keys = ["n_nationkey", "n_name", "n_regionkey", "p_brand", "d"]
    g1 = j.groupBy(*keys[:4], "p_type", F.to_date("l_shipdate").alias("d")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_linenumber").cast("bigint")).alias("ln"),
        F.sum(_cents(F.col("l_extendedprice"))).alias("ep_c"),
        F.sum(_cents(F.col("l_discount"))).alias("disc_c"),
        F.max(_cents(F.col("l_discount"))).alias("disc_max"),
        F.sum(_cents(F.col("p_retailprice"))).alias("rp_c"),
    )
    # Level 2: the (much smaller) per-type rows folded to one row per nation/brand/day.
    g = g1.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("q", "n", "ln", "ep_c", "disc_c", "rp_c")],
        F.max("disc_max").alias("disc_max"),
        F.array_min(F.collect_set("p_type")).alias("ptype"),  # hash-based (a string min sorts)
    ).join(region, F.col("n_regionkey") == region.r_regionkey).withColumnRenamed("r_name", "rname")
    k = F.dayofyear("d") + F.col("n_nationkey")
    return g.select(
        "*",
        k.alias("k"),
        _half_up_div("ep_c", "q").alias("price_c"),
        _half_up_div("(disc_c * 100)", "n").alias("disc_bp"),
        _half_up_div("rp_c", "n").alias("comp_c"),
    )


def _every(k: Column, m: int) -> Column:
    return F.pmod(k, F.lit(m)) == F.lit(0)


def _weather(k: Column) -> Column:
    r = F.pmod(k, F.lit(4))
    return (
        F.when(r == 0, "Sunny").when(r == 1, "Rainy").when(r == 2, "Cloudy").otherwise("Snowy")
    )


def _season(d: Column) -> Column:
    m = F.month(d)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def demand_panel_raw(spark: SparkSession, sf_dir: str, with_bad_dates: bool = False) -> DataFrame:
    """Fixture P as text columns (16 raw columns in CSV order, optionally ``Date_bad``)."""
    g = _panel_groups(spark, sf_dir)
    k = F.col("k")
    date_text = F.date_format("d", "yyyy-MM-dd")
    cols = {
        "Date": date_text,
        "Store ID": F.col("n_name"),
        "Product ID": F.col("p_brand"),
        "Category": F.when(~_every(k, 41), F.col("ptype")),
        "Region": F.when(~_every(k, 43), F.col("rname")),
        "Inventory Level": F.when(_every(k, 59), F.lit("n/a")).otherwise((F.col("ln") * 10).cast("string")),
        "Units Sold": F.col("q").cast("string"),
        "Units Ordered": F.col("n").cast("string"),
        "Price": F.when(~_every(k, 37), _fixed_text("price_c", 2)),
        "Discount": _fixed_text("disc_bp", 4),
        "Weather Condition": _weather(k),
        "Promotion": F.when(F.col("disc_max") >= 9, "1").otherwise("0"),
        "Competitor Pricing": _fixed_text("comp_c", 2),
        "Seasonality": _season(F.col("d")),
        "Epidemic": F.when(F.year("d") == 1998, "1").otherwise("0"),
        "Demand": F.when(~_every(k, 53), F.col("q").cast("string")),
    }
    out = [cols[c].alias(c) for c in RAW_COLUMN_ORDER]
    if with_bad_dates:
        out.append(F.when(_every(k, 97), F.lit("not-a-date")).otherwise(date_text).alias("Date_bad"))
    return g.select(*out)


def demand_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture P typed: dates and doubles; nulls where the raw text is null."""
    g = _panel_groups(spark, sf_dir)
    k = F.col("k")
    cols = {
        "Date": F.col("d"),
        "Store ID": F.col("n_name"),
        "Product ID": F.col("p_brand"),
        "Category": F.when(~_every(k, 41), F.col("ptype")),
        "Region": F.when(~_every(k, 43), F.col("rname")),
        "Inventory Level": (F.col("ln") * 10).cast("double"),
        "Units Sold": F.col("q").cast("double"),
        "Units Ordered": F.col("n").cast("double"),
        "Price": F.when(~_every(k, 37), F.col("price_c") / F.lit(100.0)),
        "Discount": F.col("disc_bp") / F.lit(10000.0),
        "Weather Condition": _weather(k),
        "Promotion": F.when(F.col("disc_max") >= 9, 1.0).otherwise(0.0),
        "Competitor Pricing": F.col("comp_c") / F.lit(100.0),
        "Seasonality": _season(F.col("d")),
        "Epidemic": F.when(F.year("d") == 1998, 1.0).otherwise(0.0),
        "Demand": F.when(~_every(k, 53), F.col("q").cast("double")),
    }
    return g.select(*[cols[c].alias(c) for c in RAW_COLUMN_ORDER])


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single line items as a panel with ties: many rows share store, product and day."""
    li = read_table(spark, sf_dir, "lineitem")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (li.join(pa, li["l_partkey"] == pa["p_partkey"]).join(su, li["l_suppkey"] == su["s_suppkey"])
            .join(na, F.col("s_nationkey") == na["n_nationkey"])
            .select(F.to_date("l_shipdate").alias("Date"), F.col("n_name").alias("Store ID"), F.col("p_brand").alias("Product ID"),
                    F.col("l_quantity").cast("double").alias("Demand"), (F.round(F.col("l_extendedprice") * 100).cast("bigint") / F.lit(100.0)).alias("Price"),
                    F.lit(0.0).alias("Discount"), F.lit(1.0).alias("Competitor Pricing"),
                    F.col("l_orderkey").cast("bigint").alias("order_key"), F.col("l_linenumber").cast("bigint").alias("line")))


def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture Q: ``request_id`` (order key) and a JSON ``body`` with invalid variants."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key = F.col("o_orderkey")

    def q(s: Column) -> Column:
        return F.concat(F.lit('"'), s, F.lit('"'))

    store = F.when(_every(key, 89), F.lit("")).otherwise(F.concat(F.lit("S"), F.pmod(F.col("o_custkey"), F.lit(25)).cast("string")))
    item = F.when(_every(key, 83), F.lit("")).otherwise(F.concat(F.lit("P"), F.pmod(F.col("o_custkey"), F.lit(50)).cast("string")))
    date = F.when(_every(key, 79), F.lit("15/01/2023")).otherwise(F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd"))
    horizon = (
        F.when(_every(key, 7), F.lit(""))
        .when(_every(key, 73), F.lit(',"horizon":"abc"'))
        .otherwise(F.concat(F.lit(',"horizon":'), F.pmod(key, F.lit(34)).cast("string")))
    )
    body = F.concat(
        F.lit('{"store_id":'), q(store), F.lit(',"item_id":'), q(item), F.lit(',"date":'), q(date), horizon, F.lit("}")
    )
    return o.select(
        key.alias("request_id"),
        F.when(_every(key, 97), F.lit("not json")).otherwise(body).alias("body"),
    )


def history_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the panel's own stores and products (every 11th for a store that it lacks)."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"), F.col("o_custkey").cast("bigint").alias("c"), "o_orderdate")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("nk"), "n_name")
    k = F.col("k")
    store = F.when(_every(k, 11), F.lit("NOWHERE")).otherwise(F.col("n_name"))
    digit = lambda x: (F.lit(1) + F.pmod(x, F.lit(5))).cast("string")
    item = F.concat(F.lit("Brand#"), digit(k), digit(F.floor(k / 5)))
    body = F.concat(F.lit('{"store_id":"'), store, F.lit('","item_id":"'), item, F.lit('","date":"'),
                    F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd"), F.lit('","horizon":'), F.pmod(k, F.lit(7)).cast("string"), F.lit("}"))
    return o.join(n, F.pmod(F.col("c"), F.lit(25)) == F.col("nk")).select(k.alias("request_id"), body.alias("body"))
