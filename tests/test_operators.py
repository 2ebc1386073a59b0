"""Branches of composite operators that the driver's tables do not reach."""

import datetime as dt
import itertools
import json
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.functions.text import FILLER_WORDS
from gondola.operators import baskets, chat, contracts, customers, enrich, fusion, incentives, outreach, quality, standardise, stores, vectors
from gondola.sources import sinks
from gondola.sources.feeds import age_group, stripe


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_fuse_sources_rejects_unknown_sources(spark):
    df = spark.createDataFrame([("1", "a1")], "ean string, name string")
    with pytest.raises(ValueError, match="unknown sources"):
        fusion.fuse_sources({"a": df}, "ean", ["name"], {"name": ["b"]})


def test_fuse_sources_takes_the_first_value_that_says_something(spark):
    a = spark.createDataFrame([("1", "n/a", "x1"), ("2", "A two", None)], "ean string, name string, brand string")
    b = spark.createDataFrame([("1", "B one", "x9"), ("3", "B three", "--")], "ean string, name string, brand string")
    got = {r["ean"]: (r["name"], r["brand"]) for r in fusion.fuse_sources({"a": a, "b": b}, "ean", ["name", "brand"]).collect()}
    assert got == {"1": ("B one", "x1"), "2": ("A two", None), "3": ("B three", None)}


def test_closure_reaches_any_distance(spark):
    rows = [(str(i), [str(i + 1)]) for i in range(1, 9)] + [("90", [str(k) for k in range(100, 160)]), ("91", [])]
    df = spark.createDataFrame(rows, "code string, alternatives array<string>")
    chain = {str(i): ("1", 9) for i in range(1, 10)}
    star = {str(i): ("100", 61) for i in [90, *range(100, 160)]}
    assert {r["code"]: (r["component"], r["members"]) for r in fusion.closure(df).collect()} == chain | star


def test_fresh_questions_keep_the_last_answer(spark):
    pairs = spark.createDataFrame([(1, day(1), "q", "old"), (2, day(3), "q", "new"), (3, day(3), "r", "bad"), (4, day(0), "s", "x")],
                                  "request_id int, chat_date date, question string, answer string")
    rejected = spark.createDataFrame([("bad",)], "answer string")
    assert [r["request_id"] for r in chat.fresh_questions(pairs, rejected, F.lit(str(day(0))).cast("date")).collect()] == [2]
    assert {r["request_id"] for r in chat.fresh_questions(pairs, rejected, F.lit(None).cast("date")).collect()} == {2, 4}


def test_name_links_feed_components(spark):
    products = spark.createDataFrame([("1", "Alpha"), ("2", "Beta"), ("3", " Beta"), ("4", "Gamma")], "code string, name string")
    alternates = spark.createDataFrame([("1", ["Beta ", "Nothing"]), ("2", ["Beta"])], "code string, names array<string>")
    links = fusion.name_links(products, alternates)
    assert {(r["code"], r["name"], r["matched"]) for r in links.collect()} == {("1", "Beta", 2), ("2", "Beta", 1)}
    edges = fusion.link_members(links, products)
    assert {r["code"] for r in edges.collect()} == {"1", "2", "3"} and edges.select("hub").distinct().count() == 1


def test_cascade_stages(spark):
    entries = [("e1", "Dipirona", "dipirona", None, "reference", "R1"), ("e2", "Novalgina", "dipirona", None, "reference", None),
               ("e3", "Acr", "x", "Merck", "similar", None), ("e4", "Paracetamol", "p", None, "similar", None),
               ("e5", "Ibuprofeno XY", "i", None, "similar", None), ("e6", "Amoxilina", "amoxicilina", None, "similar", None), ("e7", "Nimesulida", "other", None, "similar", None)]
    products = [(1, "Outro nome", "dipirona", "R1"), (2, "Novalgina", "dipirona", None), (3, "Acr Merck", "x", None), (4, "Paracetamol gotas", "p", None),
                (5, "Ibuprofeno infantil", "i", None), (6, "Amoxilinaa", "amoxicilinas", None), (7, "Nimesulidas", "nimesulida", None)]
    got = fusion.cascade_match(
        spark.createDataFrame(entries, "entry_id string, name string, ingredient string, maker string, kind string, registration string"),
        spark.createDataFrame(products, "code int, brand string, ingredient string, registration string"))
    assert {(r["entry_id"], r["code"], r["stage"]) for r in got.collect()} == {("e1", 1, 1), ("e2", 2, 2), ("e3", 3, 3), ("e4", 4, 4), ("e5", 5, 5), ("e6", 6, 6)}


def test_interchangeable_pairs_fall_back_only_without_numbers(spark):
    entries = spark.createDataFrame([("ref", "a", "1"), ("ref", "b", None), ("ref", "c", "9")], "reference_slug string, name_slug string, registration string")
    refs = spark.createDataFrame([("ref", 10)], "slug string, code int")
    others = spark.createDataFrame([("a", "2", 1, "s"), ("z", "1", 2, "s"), ("b", "5", 3, "s"), ("c", None, 4, "s"), ("c", "8", 5, "s")], "slug string, registration string, code int, kind string")
    none = spark.createDataFrame([], "reference_code int, other_code int")
    assert {r["other_code"] for r in fusion.interchangeable_pairs(entries, refs, others, none).collect()} == {2, 3, 4}
    denied = spark.createDataFrame([(10, 3)], "reference_code int, other_code int")
    assert {r["other_code"] for r in fusion.interchangeable_pairs(entries, refs, others, denied).collect()} == {2, 4}


def test_stable_ids_are_kept(spark):
    registry = spark.createDataFrame([("a", "id-a")], "ean string, id string")
    rows = spark.createDataFrame([("a", None), ("b", None), ("c", "given")], "ean string, id string")
    with_ids, new = fusion.assign_ids(rows, "ean", registry)
    first = {r["ean"]: r["id"] for r in with_ids.collect()}
    assert first["a"] == "id-a" and first["c"] == "given" and first["b"] == {r["ean"]: r["id"] for r in fusion.assign_ids(rows, "ean", new)[0].collect()}["b"]


COOL = [  # day, 7-day amount, day amount, day alone; paid amount or None
    (0, "10", "1", False, "10"), (3, "11", "2", False, None), (5, "12", "3", True, "3"), (11, "13", "4", False, None), (12, "14", "5", False, "14"),
    (13, "15", "6", True, "6"), (20, "16", "7", False, "16"),
]


def test_combo_cool_down(spark):
    rows = [(a, day(n), "G", Decimal(x), Decimal(y), alone) for a in (1, 2) for n, x, y, alone, _ in random.Random(a).sample(COOL, len(COOL))]
    df = spark.createDataFrame(rows, "account_id int, day date, combo string, cash_7d decimal(10,2), cash_day decimal(10,2), day_alone boolean")
    got = incentives.combo_cashback(df).collect()
    expected = {(day(n), Decimal(p)) for n, _, _, _, p in COOL if p}
    for a in (1, 2):
        assert {(r["day"], r["cashback"]) for r in got if r["account_id"] == a} == expected


def test_combo_needs_every_brand(spark):
    rules = spark.createDataFrame([("P", 1, "a", 5, Decimal("0.1")), ("P", 1, "b", 5, Decimal("0.1")), ("M", 2, "a", 9, Decimal("0.2"))],
                                  "combo string, priority int, brand string, units int, discount decimal(5,4)")
    lines = spark.createDataFrame([(1, day(0), "a", 5, Decimal("50")), (1, day(7), "b", 6, Decimal("60")), (2, day(0), "a", 20, Decimal("10")), (3, day(0), "b", 9, Decimal("1")),
                                   (4, day(0), "a", 5, Decimal("50")), (4, day(8), "b", 6, Decimal("60"))], "account_id int, day date, brand string, qty int, net decimal(10,2)")
    got = {(r["account_id"], r["day"], r["combo"], float(r["cash_7d"]), r["day_alone"]) for r in incentives.combo_days(lines, rules, "2023-01-01", "2025-01-01").collect()}
    assert got == {(1, day(7), "P", 11.0, False), (2, day(0), "M", 2.0, True)}


def test_reimbursement_sources_and_cap(spark):
    s = [(1, 1, p, k, day(n), q, Decimal(v)) for k, (p, n, q, v) in enumerate([(1, 0, 1, "100"), (1, 20, 2, "180"), (1, 21, 1, "50"), (2, 20, 1, "80"), (2, 22, 1, "90")])]
    sales = spark.createDataFrame(s, "account_id int, store_id int, product_id int, sale_id int, sold_on date, qty int, net decimal(10,2)")
    stock = spark.createDataFrame([(1, 2, 200.0, day(1))], "store_id int, product_id int, price double, taken_on date")
    got = {r["sale_id"]: (r["source"], r["pct"], r["capped"], r["refund"], r["first_drop"]) for r in incentives.reimbursement(sales, stock, str(day(10)), str(day(30))).collect()}
    assert got == {1: ("sale_before", 10.0, 10.0, 20.0, day(21)), 2: ("sale_before", 50.0, 20.0, 20.0, day(21)), 3: ("sale_inside", 0.0, 0.0, 0.0, None), 4: ("sale_inside", -12.5, -12.5, 0.0, None)}


def test_leaderboard_fills_up_to_ten(spark):
    rows = [(1, "m", i, f"p{i:02d}", 5 if i < 4 else 3, 100 - i, 500 if i != 15 else 0) for i in range(20)] + [(1, "full", i, "x", 5, i, 0) for i in range(14)]
    df = spark.createDataFrame(rows, "account_id int, mission string, player_id int, name string, level int, points int, coins int")
    got = incentives.leaderboard(df).collect()
    m = sorted((r["place"], r["player_id"]) for r in got if r["mission"] == "m")
    assert m == [(k + 1, k) for k in range(10)] and sum(r["mission"] == "full" for r in got) == 14
    assert json.loads(next(r["line"] for r in got if r["mission"] == "m" and r["place"] == 1)) == {"place": 1, "name": "p00", "level": 5, "prize": "R$ 5"}


def test_rules_agree_with_fp_growth(spark):
    rng = random.Random(5)
    data = {b: sorted({rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))}) for b in range(200)}
    lines = spark.createDataFrame([(b, i) for b, items in data.items() for i in items for _ in range(2)], "sale_id int, item string")
    names = spark.createDataFrame([(c, f"n{c}") for c in "abcdefgh"], "item string, name string")
    ours = baskets.association_rules(lines, "item", names, thresholds=(0.05, 0.2), block=4)
    got = {(r["a"], r["b"]): (round(r["confidence"], 9), round(r["lift"], 9), round(r["support"], 9)) for r in ours.collect()}
    two = spark.createDataFrame([(v,) for v in data.values() if len(v) > 1], "items array<string>")
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.2).fit(two).associationRules.filter("size(antecedent) = 1 AND size(consequent) = 1 AND lift > 1")
    assert got == {(r["antecedent"][0], r["consequent"][0]): (round(r["confidence"], 9), round(r["lift"], 9), round(r["support"], 9)) for r in model.collect()}


def test_rules_walk_the_ladder(spark):
    # tuned thresholds find nothing here, a lower step does
    pairs = [("a", "b"), ("a", "b"), ("a", "c"), ("b", "d")] + [(f"x{i}", f"y{i}") for i in range(40)]
    lines = spark.createDataFrame([(k, i) for k, p in enumerate(pairs) for i in p], "sale_id int, item string")
    names = lines.select("item", F.col("item").alias("name")).distinct()
    got = baskets.association_rules(lines, "item", names).collect()
    assert {(r["a"], r["b"]) for r in got} == {("a", "b"), ("b", "a")}


def test_dense_top_k_over_many_blocks(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 8)).round(3)
    v[:100] += 3  # one large group
    df = spark.createDataFrame([(i, [float(x) for x in row], i % 5) for i, row in enumerate(v)], "id int, vector array<double>, family int")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    cos = np.round(unit @ unit.T, 9)
    for floor, family in ((-1.0, False), (0.6, True)):
        got = vectors.dense_top_k(df, df.withColumnRenamed("id", "query"), 4, floor, family, pivots=7, corpus_rows=16, query_rows=20).collect()
        truth = set()
        for q in range(300):
            order = sorted((i for i in range(300) if cos[q, i] >= floor and not (family and i % 5 == q % 5)), key=lambda i: (-cos[q, i], i))
            truth |= {(q, i) for i in order[:4]}
        assert {(r["query"], r["id"]) for r in got} == truth


def test_representative_phrase_without_pairs(spark):
    rows = [("g", 0, "dor de cabeca"), ("g", 1, "febre e dor"), ("g", 2, "dor dor febre"), ("one", 0, "x"), ("tie", 0, "aa bb"), ("tie", 1, "bb aa")]
    got = vectors.representative_phrase(spark.createDataFrame(rows, "g string, i int, p string"), "g", "i", "p")
    assert {(r["g"], r["i"]) for r in got.collect()} == {("g", 2), ("one", 0), ("tie", 0)}


def payload(spark, rows):
    return spark.createDataFrame([(i, day(0), 200, json.dumps({"messages": [{"role": r, "content": c} for r, c in m]}), json.dumps([{"answer": a}])) for i, (m, a) in enumerate(rows)],
                                 "request_id int, chat_date date, status_code int, request string, response string")


def test_tuning_lines_reject_repeated_roles(spark):
    rows = [([("system", "s"), ("user", "q")], "a"), ([("user", "q1"), ("user", "q2")], "a"), ([("user", "q"), ("assistant", "x"), ("user", "q")], "x"), ([("user", "q"), ("assistant", "x")], "a"),
            ([("system", "s")], "a"), ([("user", "q")], " ")]
    got = {r["request_id"]: json.loads(r["line"])["contents"] for r in chat.tuning_lines(payload(spark, rows)).collect()}
    assert sorted(got) == [0, 2] and [m["role"] for m in got[2]] == ["user", "model", "user", "model"]
    assert got[0] == [{"role": "user", "parts": [{"text": "q"}]}, {"role": "model", "parts": [{"text": "a"}]}]


def test_question_answers_skip_default_answers(spark):
    rows = [([("user", "a"), ("user", "b")], "yes"), ([("user", "a")], "Sou uma atendente virtual"), ([("user", "VANNA")], "x"), ([("system", "s")], "x")]
    assert [(r["question"], r["answer"]) for r in chat.question_answers(payload(spark, rows)).collect()] == [("b", "yes")]


def test_conform_stops_on_bad_values(spark):
    contract = T.StructType([T.StructField("n", T.IntegerType(), False)])
    good = spark.createDataFrame([("1", "x")], "n string, extra string")
    assert contracts.conform(good, contract).collect()[0].asDict() == {"n": 1}
    for bad in ("x", None):
        with pytest.raises(Exception, match="column n"):
            contracts.conform(spark.createDataFrame([(bad,)], "n string"), contract).collect()


def test_upsert_inserts_and_updates(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None, 9), (2, "late", 8), (3, "c", 3)], "k int, v string, w int")
    got = contracts.upsert(target, source, ["k"], [F.desc("w")], insert=["k", "v"]).collect()
    assert {tuple(r) for r in got} == {(1, "a", 1), (2, None, 9), (3, "c", None)}


def test_incremental_append_to_an_empty_table(spark):
    incoming = spark.createDataFrame([(1, day(0)), (2, day(5))], "id int, day date")
    assert contracts.incremental(incoming.limit(0), incoming, "id", "day").count() == 2


def test_quality_score_card(spark):
    df = spark.createDataFrame([("x", "A", True), ("", "Z", True), ("x", None, False)], "name string, kind string, med boolean")
    got = quality.quality_score(df, ["name", "kind"], {"kind": ["A"]}, F.col("med"), (["kind"], [])).collect()
    assert [(r["quality"], r["tier"], r["outside_vocabulary"], r["missing_critical"]) for r in got] == [(100.0, "excellent", "", ""), (33.33, "poor", "kind", ""), (50.0, "fair", "", "")]


def test_integrity_can_stop_the_job(spark):
    bad = quality.integrity(spark.createDataFrame([("1",), ("1",)], "ean string"), "ean", {}, {})
    with pytest.raises(Exception, match="integrity check failed"):
        quality.require(bad).collect()


def test_send_list_respects_capacity_and_history(spark):
    c = spark.createDataFrame([(i, f"t{i // 2}", 5 if i % 2 else 4, "L", "m", i) for i in range(8)], "clerk_id int, phone string, level int, kind string, mission string, premium int")
    m = spark.createDataFrame([(1, "L", 90, False), (3, "other", 95, False), (5, "L", 95, True)], "clerk_id int, kind string, sent_at int, is_test boolean")
    got = outreach.send_list(c, m, F.lit(50), F.lit(80), cap=5).orderBy("place").collect()
    assert [(r["clerk_id"], r["level"]) for r in got] == [(5, 5), (7, 5), (3, 5)]


def test_backlog_decisions(spark):
    everything = spark.range(100).select(F.col("id").alias("code"))
    enriched = everything.filter("code < 60")
    for redo, recent, expected in ((4, 0, "all"), (30, 20, "recent only"), (30, 1, "stop")):
        wanted = spark.createDataFrame([(i, day(100 if i < recent else 0)) for i in range(redo)] + [(90, day(0))], "code int, made_on date")
        got = enrich.plan_backlog(everything, wanted, enriched, F.lit(str(day(50))).cast("date"), 0.05, 0.10).collect()
        assert {r["decision"] for r in got} == {expected}
        assert sum(r["selected"] for r in got) == 1 + {"all": redo, "recent only": recent, "stop": 0}[expected]


def test_prescription_keyword_wins(spark):
    p = spark.createDataFrame([(1, " Branca", None, "zolpidem 10"), (2, "branca", "X", None)], "code int, prescription string, stripe string, ingredient string")
    m = spark.createDataFrame([("BRANCA ", "Receita (a)", "V", 30)], "prescription string, standard string, stripe_inferred string, valid_days int")
    got = {r["code"]: tuple(r)[1:] for r in enrich.prescriptions(p, m, ["zolpidem"], "b1 azul (z)").collect()}
    assert got == {1: ("b1 azul (z)", "b1 azul", "V", 30), 2: ("receita (a)", "receita", "X", 30)}


def test_similar_name_pairs_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    names = [" ".join(rng.sample(vocabulary, rng.randrange(1, 6))) for _ in range(60)] + ["alpha"] * 40 + ["12 mg", None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    words = [{w for w in (n or "").split() if len(w) > 2 and w not in FILLER_WORDS} for n in names]
    for low in (0.2, 0.5):
        truth = {(i, j) for i, j in itertools.product(range(len(names)), repeat=2) if words[i] and words[j]
                 and low <= round(len(words[i] & words[j]) / len(words[i] | words[j]), 6) < 0.95}
        assert {(r["left_id"], r["right_id"]) for r in standardise.similar_name_pairs(df, df, low).collect()} == truth


def test_closest_terms(spark):
    v = spark.createDataFrame([("v", x) for x in ("Alpha Beta", "Alpha Beta Classic", "Gamma", "Água Doce")], "vocabulary string, term string")
    q = spark.createDataFrame([("v", x) for x in ("alpha beta clasic", "ALPHA beta", "agua", "nothing", "")], "vocabulary string, value string")
    got = {r["value"]: r["term"] for r in standardise.closest_terms(q, v).collect()}
    assert got == {"alpha beta clasic": "Alpha Beta Classic", "ALPHA beta": "Alpha Beta", "agua": "Água Doce"}


def test_account_status_rules(spark):
    accounts = spark.createDataFrame([(i, "active") for i in range(5)], "account_id int, current string")
    rows = [(1, "active"), (1, "churn_voluntary"), (2, "churn_forced"), (3, "paused"), (3, "onboarding"), (3, "churn_forced"), (4, "paused"), (4, "paused"), (4, "onboarding")]
    s = spark.createDataFrame([(a, i, x) for i, (a, x) in enumerate(rows)], "account_id int, store_id int, status string")
    got = {r["account_id"]: r["status"] for r in stores.account_status(accounts, s).collect()}
    assert got == {0: "no_stores", 1: "active", 2: "churn", 3: "onboarding", 4: "paused"}


def test_coverage_edges(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (0.0, 0.0), (60.0, 2.0)], "s double, d double")
    days = stores.coverage_days(F.col("s"), F.col("d"))
    assert [tuple(r) for r in df.select(days, stores.coverage_class(days)).collect()] == [(5.0, "Low"), (None, "No sales"), (0.0, "Low"), (30.0, "High")]


def test_rfm_orientations_mirror(spark):
    rows = [(i, day(-10 * i), i, float(i)) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "customer_id int, last_sale date, sales int, ticket double")
    usual = {r["customer_id"]: (r["r"], r["f"], r["v"]) for r in customers.rfm_segments(df, str(day(0))).collect()}
    turned = {r["customer_id"]: (r["r"], r["f"], r["v"]) for r in customers.rfm_segments(df, str(day(0)), orientation="legacy").collect()}
    assert usual[1] == (5, 1, 1) and usual[10] == (1, 5, 5)
    assert all(tuple(6 - x for x in usual[k]) == turned[k] for k in usual)


def test_feed_vocabularies(spark):
    df = spark.createDataFrame([("TARJADO EM VERMELHO SEM RETENCAO DA RECEITA", "Adulto e Pediátrico"), ("Tarja Vermelha sob restrição", "Adulto"), ("TARJA PRETA COM RETENCAO DA RECEITA", "Pediátrico"),
                                ("MEDICAMENTO NAO TARJADO", "acima de 60 anos"), (None, None)], "s string, a string")
    got = [tuple(r) for r in df.select(stripe(F.col("s")), age_group(F.col("a"))).collect()]
    assert got == [("Vermelha", "todos"), ("Vermelha Sob Restrição", "adulto"), ("Preta", "crianca"), ("Sem Tarja", "idoso"), (None, None)]


def test_database_statements():
    assert sinks.upsert_statement("t", ["id", "ean", "name", "created"], ["ean"]) == (
        "INSERT INTO t (id, ean, name, created) VALUES (%s, %s, %s, %s) ON CONFLICT (ean) DO UPDATE SET name = EXCLUDED.name")
    assert sinks.upsert_statement("t", ["ean"], ["ean"]).endswith("DO NOTHING")


def test_large_vector_rows_are_set_aside(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string").withColumns({f"t{i}": F.when(F.col("id") == 2, F.repeat(F.lit("y"), 9000)) for i in range(8)})
    whole, none = sinks.vector_rows(df, [], {}, "id")
    assert whole.collect() == df.collect() and none.collect() == []
    ready, large = sinks.vector_rows(df, [], {}, "id", {"": 10_000}, 65_536)
    assert [r["id"] for r in ready.collect()] == [1] and [r["id"] for r in large.collect()] == [2]


def test_catalog_tables_are_written_and_read(spark):
    from gondola.sources import readers

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    spark.sql("DROP TABLE IF EXISTS gondola_saved")
    sinks.save_table(df, "gondola_saved", "overwrite", ["v"])
    sinks.save_table(df, "gondola_saved", "append", ["v"])
    assert readers.table(spark, "gondola_saved").groupBy("id").count().filter("count = 2").count() == 2
    spark.sql("DROP TABLE gondola_saved")


def test_batches_reach_the_database_cursor(spark, tmp_path):
    """Every task opens one connection and sends its rows in batches."""
    log = str(tmp_path)

    class Cursor:
        def executemany(self, statement, rows):
            with open(f"{log}/{id(self)}-{rows[0][0]}", "w") as f:
                f.write(f"{statement} {len(rows)}")

    class Connection:
        def cursor(self):
            return Cursor()

        def commit(self):
            pass

        def close(self):
            pass

    sinks.write_batches(spark.range(25).coalesce(1), Connection, sinks.insert_statement("t", ["id"]), 10)
    sent = sorted(p.read_text() for p in tmp_path.iterdir())
    assert sent == ["INSERT INTO t (id) VALUES (%s) 10"] * 2 + ["INSERT INTO t (id) VALUES (%s) 5"]
