"""Scalar rules, table-driven: input and expected value per rule."""

import pytest
from pyspark.sql import functions as F

from gondola.functions import codes, pharma, scoring, text


def check(spark, cases, expr):
    """Evaluates `expr(column)` for all inputs in one frame."""
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a string")
    got = {r["i"]: r["v"] for r in rows.select("i", expr(F.col("a")).alias("v")).collect()}
    assert {a: got[i] for i, (a, _) in enumerate(cases)} == dict(cases)


def test_valid_barcode(spark):
    check(spark, [(None, False), ("1234", False), ("7896206403638", True), ("12348", True), ("", False), ("9912345678901", False),
                  ("12345678901234", False), ("78962064036a8", False), (" 12348 ", True)], codes.valid_barcode)


def test_barcode_round_trip(spark):
    rows = spark.range(500).select(codes.barcode(F.col("id")).alias("c"))
    assert rows.filter(~codes.valid_barcode(F.col("c"))).count() == 0


def test_phone(spark):
    check(spark, [("985867555", "98586-7555"), ("011985867555", "(11) 98586-7555"), ("12345678", "1234-5678"), ("1112345678", "(11) 1234-5678"),
                  ("123", None), (None, None), ("00123456789", "(01) 2345-6789")], text.phone)


def test_email_and_tax_id(spark):
    check(spark, [(" a@b.com ", "a@b.com"), ("a.b@c", None), ("a@b", None), ("", None), (None, None), ("x.y@z.w", "x.y@z.w")], text.email)
    check(spark, [("00.123.456/0001-9", "12345600019"), ("0001", "1"), (None, None)], text.tax_id)


def test_text_keys(spark):
    check(spark, [("Aspirina® 500mg", "aspirina500mg"), ("Água Sanitária - 1L", "aguasanitaria1l"), (None, None)], text.alnum_key)
    check(spark, [("Ação  Rápida!", "acao_rapida"), (None, None)], text.identifier)
    assert text.column_name(" Código (Novo); x ") == "codigo_novo__x"


def test_pipe_lists(spark):
    check(spark, [("a | b|", ["a", "b"]), ("  ", None), (None, None), ("|", [])], text.split_pipe)


def test_significant_tokens_and_jaccard(spark):
    check(spark, [("Dipirona 500mg com 20 comprimidos g100", ["dipirona", "comprimidos"]), (None, []), ("AB cd", [])], text.significant_tokens)
    rows = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a", "b"], ["b", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [round(r[0], 4) for r in rows.select(text.jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.3333, 0.0]


def test_similar_names(spark):
    rows = spark.createDataFrame(
        [("Produto Alpha", ["PRODUTO ALPHA", "Produto Alpha Plus", "Paroxetina"]), ("Produto", []), ("Produto", None), (None, ["x"]), ("500mg", ["500MG", "outro"]), ("Produto Alpha", ["Zeta"])],
        "r string, n array<string>")
    got = [r[0] for r in rows.select(text.similar_names(F.col("r"), F.col("n"))).collect()]
    assert got == [["Produto Alpha Plus"], [], None, ["x"], ["outro"], None]


def test_matching_tokens(spark):
    rows = spark.createDataFrame([("PRODUTO TESTE", None), ("Dipirona Sódica 500mg", "dipirona sódica; cafeína")], "n string, i string")
    six = text.matching_tokens(F.col("n"), F.col("i"), 6, [], 3, 3)
    assert [r[0] for r in rows.select(six).collect()] == [["PRODUTO"], ["DIPIRONA", "SODICA", "CAFEINA"]]
    blocked = text.matching_tokens(F.col("n"), F.col("i"), 6, ["DIPIRONA"], 1, 1)
    assert [r[0] for r in rows.select(blocked).collect()] == [["PRODUTO"], ["SODICA", "CAFEINA"]]


DOSAGES = [
    ("500 mg", "500mg"), ("10 mmol", "10mmol"), ("100 µg", "100mcg"), ("12,5 mg", "12.5mg"), ("50mg+12,5mg", "50mg + 12.5mg"), ("1.000mg", "1000mg"),
    ("1.000.000ui", "1000000ui"), ("1.250mg", "1.250mg"), ("≥ 1.000ui", "1000ui"), ("200ug", "200mcg"), ("10000u", "10000ui"), ("10mcg/h", "10mcg"),
    ("13,3mg/24h", "13.3mg"), ("9,0mg (4,6mg/24h)", "9.0mg"), ("(1000 + 200)mg", "1000mg + 200mg"), ("0,05mg + 0,03mg (drag a)", "0.05mg + 0.03mg"),
    ("500mg por comprimido", "500mg"), ("0,21mg/gota", "0.21mg"), ("1g de vitamina c por cápsula", "1g"), ("25 mg/mL", "25mg/mL"), ("150mg,12h", "150mg"),
    ("1 comprimido por dia", None), ("2 a 4 comprimidos a cada 8 horas", None), ("1ch", None), ("100mg - 150mg", None), ("100mg ou 1g", None),
    ("20/30mg", None), ("0,07ml/ml", None), ("10mg + 3,5g", None), ("10^3,0 ccid50", None), ("500None", None), ("n/a", None), ("", None), (None, None),
    ("0.5mg/g + 1mg/g", "0.5mg/g + 1mg/g"), ("1.000mg + 1.0005mg", "1000mg + 1.0005mg"), ("   ", None), ("  500mg  ", "500mg"), ("200 mcg", "200mcg"),
    ("0,12 %", "0.12%"), ("500 mui", "500mui"), ("2 ud", "2ud"), ("50mg  +  12,5mg", "50mg + 12.5mg"), ("NoneNone", None), ("Nonemg", None),
    ("500mg por cápsula", "500mg"), ("25mg/mL por dose", "25mg/mL"), ("200mg por sachê", "200mg"), ("100.000ui/ml", "100000ui/ml"), ("0.125mg", "0.125mg"),
    ("10.250mg", "10.250mg"), ("15mcg/cepa", "15mcg"), ("15mcg/cepa/0,5ml", "15mcg"), ("1500mg por porção", "1500mg"), ("0,25mg por quilo de peso corpóreo", "0.25mg"),
    ("0,1g por kg de peso corporal", "0.1g"), ("15mcg para cada cepa", "15mcg"), ("2,2mcg para cada sorotipo", "2.2mcg"), ("1000mg de ômega 3 por cápsula", "1000mg"),
    ("15mcg de hemaglutinina/cepa", "15mcg"), ("200mg de cafeína + 300mg de taurina", "200mg + 300mg"), ("1.350 ufp", None), ("25tru/g", None), ("15 lf toxoide", None),
    ("40 u.d. poliovírus", None), ("1d", None), ("100 u", "100ui"), ("15-19mg/ml", None), ("0.1 a 0.25 g/kg", None), ("100mg, 200mg", None), ("100/25mg", None),
    ("0,4mg/mg", None), ("10mg + 3,5g + 12g", None), ("0.5mg/g", "0.5mg/g"), ("2 comprimidos a cada 8 horas", None), ("1 a 2 comprimidos até 4 vezes ao dia", None),
    ("0,125mg (com branco)", "0.125mg"), ("100mg (ampola 1) + 5mg (ampola 2)", "100mg + 5mg"), ("> 20 ui", "20ui"), ("500mg +", None),
    ("(120+120+120)mcg/ml", "120mcg/ml + 120mcg/ml + 120mcg/ml"), ("(0,05mg + 0,03mg) + (0,075mg + 0,04mg)", "0.05mg + 0.03mg + 0.075mg + 0.04mg"),
    ("2,0 x 10e13 gv/ml", None),
]


def test_dosage(spark):
    check(spark, DOSAGES, pharma.dosage)


def test_dosage_in_name(spark):
    check(spark, [("Dipirona 500mg Comprimido", "500mg"), ("Amoxicilina 500mg/5mL Susp", "500mg/5mL"), ("Hidrocortisona 1% Creme", "1%"),
                  ("Insulina 100 UI/mL", "100UI/mL"), ("Shampoo 400ml", None), ("Pomada 10g", None), (None, None)], pharma.dosage_in_name)


def test_ingredient(spark):
    check(spark, [
        ("paracetamol;cafeina", "CAFEINA + PARACETAMOL"), ("Cafeína, cafeina", "CAFEINA"), ("metformina (cloridrato)", "CLORIDRATO DE METFORMINA"),
        ("metformina cloridrato", "CLORIDRATO DE METFORMINA"), ("cloridrato metformina", "CLORIDRATO DE METFORMINA"), ("cloridrato de metformina", "CLORIDRATO DE METFORMINA"),
        ("acetilsalicílico ácido", "ACIDO ACETILSALICILICO"), ("amoxicilina triidratada", "AMOXICILINA TRI-HIDRATADA"), ("dipirona 500 mg", "DIPIRONA"),
        ("clorexidina 0,12%", "CLOREXIDINA"), ("a\r\nb", "A + B"), ("zolpidem + alprazolam + diazepam", "ALPRAZOLAM + DIAZEPAM + ZOLPIDEM"),
        ("paracetamol   +   cafeina", "CAFEINA + PARACETAMOL"), ("losartana potássica;hidroclorotiazida", "HIDROCLOROTIAZIDA + LOSARTANA POTASSICA"),
        ("   ", "   "), ("cloridrato de x (5 mg)", "CLORIDRATO DE X"), ("", ""), (None, None)], pharma.ingredient)


def test_forms_and_streets(spark):
    check(spark, [("Gel / Creme (tubo)", ["gel", "creme"]), ("Comprimido,Cápsula", ["comprimido", "capsula"]), (None, [])], pharma.forms)
    check(spark, [
        ("R. das Flores nº 10 - Centro", "Rua das Flores, 10"), ("Av. Brasil, 200", "Avenida Brasil, 200"), ("Rua 27 de Setembro 258", "Rua 27 de Setembro, 258"),
        ("Rua Nova, 12B apto 3", "Rua Nova, 12B"), ("Praça da Sé", "Praça da Sé"), (None, None), ("R.Sol 5", "Rua Sol, 5"), ("Rua 13, 45 fundos", "Rua 13, 45"), ("Av. Gov. Dix n° 7a/b", "Avenida Governador Dix, 7a"),
        ("Presidente Vargas, s/n", "Presidente Vargas"), ("Rua Sete 45 fundos", "Rua Sete, 45")], pharma.street_and_number)


@pytest.mark.parametrize("value, cuts, up, down", [(0, [1, 2, 3, 4], 1, 5), (1, [1, 2, 3, 4], 1, 5), (2, [1, 2, 3, 4], 2, 4), (5, [1, 2, 3, 4], 5, 1),
                                                   (25.2, [1, 10, 30, 35], 3, 3), (50, [1, 10, 30, 35], 5, 1)])
def test_quintile(spark, value, cuts, up, down):
    c = [F.lit(x) for x in cuts]
    row = spark.range(1).select(scoring.quintile(F.lit(value), c).alias("u"), scoring.quintile(F.lit(value), c, False).alias("d")).head()
    assert (row["u"], row["d"]) == (up, down)


def test_age_band(spark):
    ages = [(0, "bebe"), (1, "bebe"), (2, "crianca"), (12, "crianca"), (13, "adolescente"), (18, "jovem"), (25, "adulto"), (60, "idoso"), (None, None), (-1, None)]
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ages)], "i int, a int").orderBy("i")
    assert [r[0] for r in rows.select(scoring.age_band(F.col("a"))).collect()] == [b for _, b in ages]


def test_says_nothing(spark):
    bad, good = [None, "", " ", "n/a", "N/D", "-", "...", "a", "aaaa", "!?_", "12345"], ["500mg", "ab", "EMS S/A"]
    check(spark, [(x, True) for x in bad] + [(x, False) for x in good], scoring.says_nothing)
    check(spark, [("12345", False), ("1111", False), ("1", True), ("aaaa", True)], lambda c: scoring.says_nothing(c, True))


def test_sweep_nothing(spark):
    df = spark.createDataFrame([("n/a", "123", "n/a", ["-", "ok"], 1), ("x1", "n/a", "", ["", None], 2)], "a string, code string, id string, l array<string>, n int")
    got = scoring.sweep_nothing(df, ["id"], ["code"]).collect()
    assert [tuple(r) for r in got] == [(None, "123", "n/a", ["ok"], 1), ("x1", None, "", None, 2)]


def test_html_text(spark):
    check(spark, [("<p>a<b>b</b></p><script>var x='</p>'</script> c&nbsp;&amp;lt;", "a b c &lt;"), (None, None)], text.html_text)


def test_first_largest(spark):
    df = spark.createDataFrame([(1, 3, 3), (0, 0, 0), (None, None, None), (None, 2, 1)], "a int, b int, c int")
    assert [r[0] for r in df.select(scoring.first_largest(["a", "b", "c"])).collect()] == ["b", None, None, "b"]
