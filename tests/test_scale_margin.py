"""Campaign lines are found without pairing stores and products."""

from datetime import date

from gondola.operators import incentives


def test_lines_meet_the_campaigns_of_product_and_store(spark):
    lines = [(1, 10, date(2001, 1, 1), 2, 30.0, 5), (1, 11, date(2001, 1, 2), 1, 10.0, 5), (2, 10, date(2001, 1, 3), 4, 65.0, 7), (None, 10, date(2001, 1, 3), 9, 9.0, 9)]
    products, stores = [(10, "A"), (10, "B"), (11, None)], [(1, "A"), (2, "B"), (2, None), (2, "A")]
    df = incentives.campaign_margin(
        spark.createDataFrame(lines, "store_id int, product_id int, sold_on date, qty long, net double, coins long"),
        spark.createDataFrame(products, "product_id int, campaign string"), spark.createDataFrame(stores, "store_id int, campaign string"), "2001-08-02", 6.5)
    got = {(r["campaign"], r["product_id"]): (r["qty"], r["value"], r["coins"], r["margin"]) for r in df.collect()}
    assert got == {("A", 10): (6, 95.0, 12, 2.62), ("B", 10): (4, 65.0, 7, 3.0)}
