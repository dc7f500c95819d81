import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.functions import numeric, tails, text


def plain(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_accents_and_keys_match_the_unicode_rules(spark):
    rng = random.Random(1)
    chars = [chr(c) for c in range(0x20, 0x2200) if unicodedata.category(chr(c))[0] in "LNPZ" and chr(c).islower() is not None]
    words = ["".join(chars[i:i + 40]) for i in range(0, len(chars), 40)]
    words += ["  Côte  d’Ivoire ", "STRASSE straße", "ﬁancé ½ №5", "", "Irã x"]
    words += ["".join(rng.choices(chars[:600], k=12)) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(words)), "i int, s string").select(
        "s", text.strip_accents(F.col("s")).alias("plain"), text.name_key(F.col("s")).alias("key")
    ).collect()
    for r in rows:
        assert r["plain"] == plain(r["s"])
    for r in rows:
        latin = all(ord(c) < 0x250 or c in "’ﬁ№" for c in r["s"])
        if latin:
            assert r["key"] == re.sub(r"\s+", " ", plain(r["s"])).strip().casefold()


def test_null_text_is_an_empty_key(spark):
    r = spark.sql("select cast(null as string) s").select(text.plain_lower(F.col("s")).alias("p"), text.name_key(F.col("s")).alias("k")).first()
    assert (r["p"], r["k"]) == ("", "")


def test_codes_and_slugs(spark):
    df = spark.createDataFrame([("4",), ("076",), ("1234",)], "c string")
    assert [r[0] for r in df.select(text.zero_fill(F.col("c"), 3)).collect()] == ["004", "076", "1234"]
    r = spark.range(1).select(text.slug(F.lit("Tea (including Maté)"), "f_", "_kg").alias("s")).first()
    assert r["s"] == "f_tea_including_mate_kg" == text.slug_text("Tea (including Maté)", "f_", "_kg")


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("6.0",), (" 7 ",), ("x",), ("NaN",), (None,), ("-2.9",), ("7D",), ("1.5f",), ("1e3",), (".5",), ("-",), ("5.",)], "t string")
    rows = df.select(numeric.to_double(F.col("t")).alias("d"), numeric.to_int(F.col("t")).alias("i")).collect()
    assert [tuple(r) for r in rows] == [(6.0, 6), (7.0, 7), (None, None), (None, None), (None, None), (-2.9, -2), (None, None), (None, None), (1000.0, 1000), (0.5, 0), (None, None), (5.0, 5)]


def test_row_sum_and_mean_keep_all_null_rows_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 4.0)], "a double, b double")
    rows = df.select(numeric.row_sum([F.col("a"), F.col("b")]), numeric.row_mean([F.col("a"), F.col("b")])).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0), (None, None), (6.0, 3.0)]


def test_spline_is_linear_beyond_the_outer_knots(spark):
    knots = [1.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(float(x),) for x in (-3, 0, 1, 8, 9, 10, 11)], "x double")
    rows = df.select(*numeric.spline_terms(F.col("x"), knots)).collect()
    for j in range(2):
        values = [r[j] for r in rows]
        assert values[:3] == [0.0, 0.0, 0.0]
        second = np.diff(values[3:], 2)
        assert np.allclose(second, 0.0, atol=1e-9)
    with pytest.raises(ValueError):
        numeric.spline_terms(F.col("x"), [1.0, 1.0, 2.0])


def test_tails():
    assert math.isclose(tails.t_two_sided(2.0, 10), 0.07338803477074034, rel_tol=1e-10)
    assert math.isclose(tails.t_two_sided(1.959963984540054, 1e9), 0.05, rel_tol=1e-6)
    assert math.isclose(tails.f_upper(4.0, 1, 10), tails.t_two_sided(2.0, 10), rel_tol=1e-10)
    assert math.isclose(tails.f_upper(3.0, 4, 20), 0.043115386, rel_tol=2e-2)
    grid = np.linspace(2.5, 400, 4_000_001)
    density = np.exp(math.lgamma(2.5) - math.lgamma(2.0)) / math.sqrt(4 * math.pi) * (1 + grid**2 / 4) ** -2.5
    assert math.isclose(tails.t_two_sided(2.5, 4), 2 * np.trapezoid(density, grid), rel_tol=1e-5)
