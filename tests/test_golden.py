"""Golden values of the reference's own tests and stage files."""

from pyspark.sql import functions as F

from vitrine.functions.text import normalize_ws, price_locale, rating_parse, reviews_parse
from vitrine.operators import clean as CL
from vitrine.operators import label as LB
from vitrine.operators.interpret import confidence_band


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_whitespace(spark):
    assert one_col(spark, ["  Cartucho   HP   664   Original  "], normalize_ws) == ["Cartucho HP 664 Original"]


def test_price_locale(spark):
    got = one_col(spark, ["R$ 89,90", "89.90", "1234", "invalid", "R$ 1.234,56", "1,234.56", "$1,234.56", "1.234", "1,234", ""],
                  price_locale)
    assert got == [89.9, 89.9, 1234.0, None, 1234.56, 1234.56, 1234.56, 1234.0, 1234.0, None]


def test_rating(spark):
    assert one_col(spark, ["4,8 estrelas", "Rating: 3.5/5", "6.0", "-1.0", "none"], rating_parse) == [4.8, 3.5, 5.0, 0.0, None]


def test_reviews(spark):
    assert one_col(spark, ["150 avaliações", "1.234 reviews", "no reviews", None], reviews_parse) == [150, 1234, 0, 0]


def test_product_type(spark):
    got = one_col(spark, ["Cartucho HP 664", "Toner HP 85A", "Tinta HP GT52", "Impressora HP"], lambda c: CL.product_type(c))
    assert got == ["cartucho", "toner", "tinta", "outros"]


def test_valid_listing(spark):
    df = spark.createDataFrame([("Packard Bell printer", "u1"), ("Canon printer", "u2"), ("HP 664", "")], "title string, url string")
    assert [r.title for r in CL.valid_listing(df).collect()] == ["Packard Bell printer"]


def test_listing_caps(spark):
    df = spark.createDataFrame([("x" * 600, "d" * 2500, "s" * 300, "R$ 1,00", "4", "1", None, "u")],
                               "title string, description string, seller_name string, price string, rating string, "
                               "reviews_count string, platform string, url string")
    r = CL.listing_clean(df).first()
    assert (len(r.title), len(r.description), len(r.seller_name), r.platform) == (500, 2000, 200, "mercadolivre")


def test_confidence_bands(spark):
    got = one_col(spark, [0.95, 0.85, 0.75, 0.65, 0.45], confidence_band, "double")
    assert got == ["Very High", "High", "Moderate", "Low", "Very Low"]


def test_heuristic_rules(spark):
    rows = [
        ("Cartucho HP 664 Original", "lacrado", "Loja Oficial HP", 250.0, 4.5, 10),   # o: .4 + .3 + .1
        ("Cartucho compatível", "", "Seller 1", 20.0, 2.0, 100),                     # s: .4 + .3 + .2
        ("Cartucho H.P. 122 original", "", "Loja Online SA", 50.0, None, 0),         # both
        ("Impressora", None, None, None, None, None),                                # unknown
    ]
    df = spark.createDataFrame(rows, "title string, description string, seller_name string, price_numeric double, "
                                     "rating_numeric double, reviews_count int")
    got = [(r.label, round(r.confidence, 6)) for r in LB.heuristic_label(df).collect()]
    assert got == [("original", 0.8), ("pirate/suspicious", 0.9), ("mixed_signals", 0.5), ("unknown", 0.0)]


def test_enrichment(spark):
    df = spark.createDataFrame([("Cartucho HP 664 Original", "modelo: F6V28AB cor: preto rendimento: 120 paginas nota fiscal"),
                                ("Cartucho compativel", "garantia")], "title string, description string")
    r = LB.enrich_table(df).collect()
    assert (r[0].classificacao_produto, r[0].modelo, r[0].cor, r[0].rendimento_paginas, r[0].tem_nota_fiscal) == \
        ("Original", "F6V28AB", "Preto", 120, True)
    assert (r[1].classificacao_produto, r[1].tem_garantia) == ("Compatível", True)
