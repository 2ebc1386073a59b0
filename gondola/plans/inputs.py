"""The driver's tables in the roles the operators expect, as DataFrames and (for the equivalent
statements) as SQL text with the same columns.

sale = order, sale line = lineitem, product = part, store = supplier, account (chain) = nation of the
store, group = region, customer = customer; event users stand for clerks and chat users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.codes import barcode
from gondola.operators.kit import hashed_side
from gondola.plans.registry import Tables

AS_OF = "2001-08-02"


def money(name: str) -> Column:
    return F.col(name).cast("decimal(10,2)")


def net() -> Column:
    """Line money as an exact decimal, so that sums do not depend on the order of rows."""
    return (money("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))).cast(
        "decimal(16,4)")


NET_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(16,4))"


def lines(t: Tables) -> DataFrame:
    """Sale lines without their header: no join."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("long").alias("qty"),
        money("l_extendedprice").alias("gross"),
        net().alias("net"),
        F.to_date("l_shipdate").alias("shipped_on"),
        F.col("l_returnflag").alias("sale_kind"),
        F.col("l_linestatus").alias("channel"),
    )


LINES = f"""lines AS (
  SELECT l_orderkey AS sale_id, l_partkey AS product_id, l_suppkey AS store_id,
         CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(10,2)) AS gross, {NET_SQL} AS net,
         CAST(l_shipdate AS DATE) AS shipped_on, l_returnflag AS sale_kind, l_linestatus AS channel
  FROM lineitem)"""


def headers(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("sold_on"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("sale_value"),
    )


HEADERS = """headers AS (
  SELECT o_orderkey AS sale_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS sold_on,
         o_orderstatus AS status, o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(12,2)) AS sale_value
  FROM orders)"""


def sales(t: Tables) -> DataFrame:
    """Sale lines with the columns of their header."""
    return lines(t).join(hashed_side(headers(t), t.line_rows), "sale_id")


SALES = f"""{LINES}, {HEADERS}, sales AS (
  SELECT l.*, h.customer_id, h.sold_on, h.status, h.priority, h.sale_value
  FROM lines l JOIN headers h ON l.sale_id = h.sale_id)"""


def stores(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
        F.col("s_nationkey").alias("account_id"), F.col("s_acctbal").alias("balance"))


STORES = """stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, s_nationkey AS account_id, s_acctbal AS balance FROM supplier)"""


def accounts(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("account_id"), F.col("n_name").alias("account_name"),
        F.col("n_regionkey").alias("group_id"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"), F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("list_price"),
        barcode(F.col("p_partkey")).alias("ean"))


_BODY = "lpad(CAST(p_partkey AS VARCHAR), 12, '0')"
_SUM = " + ".join(f"{3 if i % 2 else 1} * CAST(substr({_BODY}, {i + 1}, 1) AS INTEGER)" for i in range(12))
EAN_SQL = f"({_BODY} || CAST((10 - ({_SUM}) % 10) % 10 AS VARCHAR))"
PRODUCTS = f"""products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand, p_type AS category, p_size AS size,
         CAST(p_retailprice AS DECIMAL(10,2)) AS list_price, {EAN_SQL} AS ean
  FROM part)"""


def seconds(c: Column) -> Column:
    """Whole seconds since the epoch of a timestamp, whatever its zone flavour."""
    return F.unix_timestamp(c.cast("timestamp"))


def feed(t: Tables) -> DataFrame:
    """Events with their JSON property and the second they happened."""
    return t.events.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"),
        F.to_date("ts").alias("day"))


FEED = """feed AS (
  SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS at_us, CAST(ts AS DATE) AS day
  FROM events)"""


def r(expr: str, digits: int) -> str:
    """Rounds half up on the shortest decimal form of a double, as Spark does."""
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def cost() -> Column:
    """Stand-in for the purchase cost of a line: units at list price."""
    return (F.col("qty") * F.col("list_price")).cast("decimal(16,4)")


COST_SQL = "CAST(qty * list_price AS DECIMAL(16,4))"


def as_doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def nothing_sql(e: str, allow_numeric: bool = False) -> str:
    """Statement form of `says_nothing`."""
    from gondola.functions.scoring import EMPTY_LITERALS

    t = f"trim({e})"
    digits = f"regexp_matches({t}, '^\\d+$')"
    repeated = f"length(replace(lower({t}), left(lower({t}), 1), '')) = 0"
    out = (f"{e} IS NULL OR {t} = '' OR lower({t}) IN ({', '.join(repr(v) for v in EMPTY_LITERALS)}) "
           f"OR regexp_matches({t}, '^[\\W_]+$') OR length({t}) = 1 OR ({repeated}{f' AND NOT {digits}' if allow_numeric else ''})")
    return f"({out}{'' if allow_numeric else f' OR {digits}'})"


def slug_sql(e: str) -> str:
    return f"regexp_replace(regexp_replace(lower(strip_accents(trim({e}))), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"


def key_sql(e: str) -> str:
    return f"regexp_replace(strip_accents(lower(trim({e}))), '[^a-z0-9]+', '', 'g')"
