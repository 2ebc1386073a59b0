"""Readers and writers: driver tables are written to the shared scratch folder in a landing format and read
back from there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gondola.plans import inputs as src
from gondola.plans.inputs import LINES, PRODUCTS
from gondola.plans.registry import query
from gondola.sources import readers, sinks
from gondola.streaming.incremental import work_folder

_CUSTOMERS = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("s02_parquet_prune", "SELECT p_brand, count(*) AS products FROM part WHERE p_size > 40 GROUP BY 1")
def parquet_prune(t):
    return readers.parquet(t.spark, f"{t.folder}/part.parquet").filter("p_size > 40").groupBy("p_brand").agg(F.count(F.lit(1)).alias("products"))


@query("s03_json_lines", "SELECT * FROM customer")
def json_lines(t):
    path = work_folder(t.spark, "lines")
    sinks.save_json(t.customer, path)
    return readers.json_lines(t.spark, path, _CUSTOMERS)


def _page_files(t) -> str:
    """JSON documents of fifty suppliers each, one per file, all in one folder: a task writes as many files as it has documents."""
    path = work_folder(t.spark, "pages")
    page = t.supplier.withColumn("p", F.expr("s_suppkey div 50")).groupBy("p").agg(
        F.to_json(F.struct(F.collect_list(F.struct("s_suppkey", "s_name")).alias("results"))).alias("value"))
    page.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("s04_json_files", "SELECT s_suppkey, s_name FROM supplier")
def json_files(t):
    pages = readers.json_files(t.spark, _page_files(t), "results array<struct<s_suppkey:bigint,s_name:string>>", "*.txt")
    return pages.select(F.inline("results"))


@query("s05_json_pages", "SELECT s_suppkey, s_name FROM supplier")
def json_pages(t):
    schema = "results array<struct<s_suppkey:bigint,s_name:string>>"
    return readers.json_pages(t.spark, _page_files(t), schema, F.col("page.results"), "*.txt").drop("file")


@query("s06_pipe_csv", "SELECT DISTINCT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS qty FROM lineitem")
def pipe_csv(t):
    path = work_folder(t.spark, "csv")
    rows = src.lines(t).select(F.col("sale_id").alias("l_orderkey"), F.col("product_id").alias("l_partkey"), "qty")
    again = rows.filter("l_orderkey % 4 = 0")
    rows.unionByName(again).write.option("sep", "|").option("header", "true").csv(path)
    return readers.pipe_csv(t.spark, path, "l_orderkey BIGINT, l_partkey BIGINT, qty BIGINT")


@query("s07_latin1_csv", "SELECT p_partkey, p_name || ' ção' AS name FROM part")
def latin1_csv(t):
    path = work_folder(t.spark, "latin")
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit(" ção")).alias("name"))
    rows.write.option("sep", "|").option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    return readers.pipe_csv(t.spark, path, "p_partkey BIGINT, name STRING", "ISO-8859-1")


@query("s09_latest_partition", """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def latest_partition(t):
    path = work_folder(t.spark, "dated")
    sinks.save_partitions(t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")), path, ["year"])
    return readers.latest_partition(t.spark.read.parquet(path), "year")


@query("s01_catalog_read", """
SELECT c_custkey, c_mktsegment, count(o_orderkey) AS orders, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(14,2))), 0) AS DOUBLE) AS total
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""")
def catalog_read(t):
    """Two tables of the catalog, bucketed by customer, joined and summed where they lie."""
    return bucketed_totals(t, 16)


def bucketed_totals(t, buckets: int):
    names = {}
    for name, key in (("customer", "c_custkey"), ("orders", "o_custkey")):
        names[name] = f"gondola_{name}_{uuid.uuid4().hex}"
        sinks.save_bucketed(t.read(name), names[name], [key], buckets, work_folder(t.spark, name))
    customers, orders = (readers.table(t.spark, names[n]) for n in ("customer", "orders"))
    joined = customers.select(F.col("c_custkey").alias("customer"), "c_mktsegment").hint("merge").join(
        orders.select(F.col("o_custkey").alias("customer"), "o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("price")), "customer", "left")
    out = joined.groupBy("customer", "c_mktsegment").agg(
        F.count("o_orderkey").alias("orders"), F.coalesce(F.sum("price"), F.lit(0)).cast("double").alias("total"))
    return out.withColumnRenamed("customer", "c_custkey")


@query("s10_append_table", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def append_table(t):
    """Two appends into one table; the batch in between replaces nothing."""
    path = work_folder(t.spark, "append")
    for part in ("c_nationkey < 12", "c_nationkey >= 12"):
        t.customer.filter(part).write.mode("append").parquet(path)
    return readers.parquet(t.spark, path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("s11_partition_overwrite", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'new' ELSE 'old' END AS state, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderkey % 2 = 1)""")
def partition_overwrite(t):
    path = work_folder(t.spark, "parts")
    rows = t.orders.select("o_orderkey", F.lit("old").alias("state"), F.year("o_orderdate").alias("year"))
    sinks.save_partitions(rows, path, ["year"])
    sinks.save_partitions(rows.filter("year = 1997 AND o_orderkey % 2 = 0").withColumn("state", F.lit("new")), path, ["year"], "overwrite")
    return t.spark.read.parquet(path)


@query("s12_text_lines", "SELECT p_partkey || ':' || p_name AS value FROM part")
def text_lines(t):
    path = work_folder(t.spark, "text")
    sinks.save_lines(t.part.select(F.concat_ws(":", F.col("p_partkey").cast("string"), "p_name").alias("line")), "line", path)
    return t.spark.read.text(path)


# What the vector store of the survey holds per text column and row.
STORE_TEXTS, STORE_ROW = {"ean": 20, "phrase": 500, "ingredient": 1000, "": 10_000}, 65_536


@query("s17_vector_rows", f"""
WITH {PRODUCTS}, x AS (SELECT product_id, substr(ean || ean, 1, 20) AS ean, lower(category) AS category, substr(repeat(name || ' ', 100), 1, 500) AS phrase,
  size % 3 = 0 AS unstriped, size % 25 = 1 AS too_large FROM products)
SELECT product_id, CASE WHEN too_large THEN NULL ELSE ean END AS ean, CASE WHEN too_large THEN NULL ELSE category END AS category,
  CASE WHEN too_large THEN NULL ELSE md5(phrase) END AS phrase, CASE WHEN too_large THEN NULL ELSE unstriped END AS unstriped, NOT too_large AS ready FROM x""")
def vector_rows(t):
    rows = src.products(t).select(
        "product_id", F.concat("ean", "ean").alias("ean"), F.concat(F.lit(" "), "category").alias("category"), F.repeat(F.concat("name", F.lit(" ")), 100).alias("phrase"),
        F.when(F.col("size") % 3 == 0, False).when(F.col("size") % 3 == 1, True).alias("striped"),
        F.when(F.col("size") % 25 == 1, F.sequence(F.lit(100_000), F.lit(120_000))).alias("codes"))
    ready, large = sinks.vector_rows(rows, ["category"], {"unstriped": "striped"}, "product_id", STORE_TEXTS, STORE_ROW)
    kept = ready.select("product_id", "ean", "category", F.md5("phrase").alias("phrase"), "unstriped", F.lit(True).alias("ready"))
    return kept.unionByName(large.withColumn("ready", F.lit(False)), allowMissingColumns=True)


@query("s18_view_over_join", f"WITH {LINES}, {PRODUCTS} SELECT brand, CAST(sum(qty) AS BIGINT) AS units FROM lines JOIN products USING (product_id) GROUP BY 1")
def view_over_join(t):
    src.lines(t).createOrReplaceTempView("gondola_lines")
    src.products(t).createOrReplaceTempView("gondola_products")
    t.spark.sql("CREATE OR REPLACE TEMPORARY VIEW gondola_sold AS SELECT brand, qty FROM gondola_lines JOIN gondola_products USING (product_id)")
    return t.spark.sql("SELECT brand, sum(qty) AS units FROM gondola_sold GROUP BY brand")


@query("s19_guarded_updates", """
WITH x AS (SELECT CASE WHEN p_partkey % 4 = 3 THEN 'unknown' WHEN p_retailprice > 0 AND p_size < 40 THEN 'sent' ELSE 'broken' END AS state FROM part)
SELECT state, count(*) AS updates FROM x GROUP BY 1""")
def guarded_updates(t):
    _, report = sinks.guarded_updates(t.part, t.part.filter("p_partkey % 4 <> 3"), "p_partkey", {
        "price": F.col("p_retailprice") > 0, "size": F.col("p_size") < 40})
    return report
