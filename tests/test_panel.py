from collections import Counter

import numpy as np
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.functions.vocab import COUNTRY_ALIASES
from panelspark.operators import lookup, panel, quality, schema
from panelspark.operators.quality import QualityError
from panelspark.session import settings


def test_resolvers(spark):
    df = spark.createDataFrame([(1, "a", "x")], "Code int, iso3 string, `X2 - Proporcao` string")
    assert schema.first_present(df.columns, ["ISO3", "iso3", "Code"]) == "iso3"
    assert schema.find_loose(df.columns, ("CODE ",), ()) is None and schema.find_loose(df.columns, ("code",)) == "Code"
    assert schema.find_by_hints(df.columns, ["x2", "proporcao"]) == "X2 - Proporcao"
    assert schema.find_by_hints(df.columns, ["x2_proporcao"]) == "X2 - Proporcao"
    assert schema.find_by_hints(df.columns, ["x3"]) is None
    spellings = [" Year ", "year", "Year of birth", "Birth year"]
    assert schema.find_loose(spellings, ("ano", "YEAR")) == " Year "  # the first column wins
    assert schema.find_loose(spellings, ("birth year", "year")) == "Birth year"  # the first name wins
    assert schema.find_loose(spellings, ("none",), ("birth", "Year")) == "Year of birth"
    assert schema.alias_project(df, {"a": ["iso3"], "b": ["zz"]}, "s").columns == ["a", "fonte"]
    assert schema.alias_project(df, {"a": ["iso3"], "b": ["zz"]}, "s", keep_absent=True).columns == ["a", "b", "fonte"]
    assert schema.missing_targets(df.columns, {"a": ["iso3"], "b": ["zz"]}) == ["b"]
    with pytest.raises(ValueError, match="missing columns"):
        schema.require_columns(df, ["nope"])
    assert schema.numeric_columns(df) == ["Code"]


def test_pivot_drops_keys_without_any_value(spark):
    rows = [("A", 1, "m", 1.0), ("A", 1, "m", 3.0), ("B", 1, "m", None), (None, 1, "m", 2.0), ("C", 1, "n", 5.0), ("D", 1, None, 5.0)]
    df = spark.createDataFrame(rows, "u string, t int, k string, v double")
    wide = panel.pivot_mean(df, ["u", "t"], "k", "v", prefix="p_")
    assert sorted(tuple(r) for r in wide.select("u", "t", "p_m", "p_n").collect()) == [("A", 1, 2.0, None), ("C", 1, None, 5.0)] or \
        {r["u"]: (r["p_m"], r["p_n"]) for r in wide.collect()} == {"A": (2.0, None), "C": (None, 5.0)}


def test_many_measures_take_the_pivot_and_agree(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), 1, f"m{rng.randrange(50)}", rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "u int, t int, k string, v double")
    names = sorted({r[2] for r in rows})
    assert len(names) == 50
    wide = {r["u"]: r for r in panel.pivot_mean(df, ["u", "t"], "k", "v").collect()}
    for u in range(5):
        for n in names:
            cell = [v for a, _, k, v in rows if a == u and k == n]
            assert wide[u][n] == (pytest.approx(sum(cell) / len(cell)) if cell else None)
    unique = df.groupBy("u", "t", "k").agg(F.max("v").alias("v"))
    assert panel.pivot_strict(unique, ["u", "t"], "k", "v").count() == 5
    with pytest.raises(PySparkException, match="duplicate cell"):
        panel.pivot_strict(df, ["u", "t"], "k", "v").collect()


USES = [
    lambda df, key: df.collect(), lambda df, key: df.count(), lambda df, key: df.select(key).collect(),
    lambda df, key: df.drop(key).collect(), lambda df, key: df.filter(F.col(key) == "none").collect(),
]


@pytest.mark.parametrize("use", USES)
def test_gates_hold_whatever_is_selected(spark, use):
    long = spark.createDataFrame([("A", 1, "m", 1.0), ("A", 1, "m", 2.0), ("B", 1, "z", 1.0)], "u string, t int, k string, v double")
    with pytest.raises(PySparkException, match="duplicate cell"):
        use(panel.pivot_strict(long, ["u", "t"], "k", "v", ["m", "z"]).drop("m"), "u")
    part = long.select("u", "t", "v")
    with pytest.raises(PySparkException, match="duplicate key"):
        use(panel.outer_panel({"a": part, "b": part.select("u", "t").distinct().selectExpr("u", "t", "1 as w")}, ["u", "t"]), "u")


def test_listed_measures_bound_the_keys(spark):
    df = spark.createDataFrame([("A", "m", 1.0), ("B", "other", 1.0)], "u string, k string, v double")
    assert [r["u"] for r in panel.pivot_mean(df, ["u"], "k", "v", ["m", "absent"]).collect()] == ["A"]


def test_too_many_measures_are_refused(spark):
    df = spark.range(12).select(F.lit(1).alias("k"), F.concat(F.lit("m"), "id").alias("m"), F.col("id").cast("double").alias("v"))
    with settings(spark, {"spark.sql.pivotMaxValues": 11}), pytest.raises(QualityError, match="more than 11"):
        panel.pivot_mean(df, ["k"], "m", "v")
    with settings(spark, {"spark.sql.pivotMaxValues": 12}):
        assert len(panel.pivot_mean(df, ["k"], "m", "v").columns) == 13


def test_sources_of_groups(spark):
    df = spark.createDataFrame(
        [("a", "GBD"), ("a", "gbd"), ("a", None), ("b", "gbd"), ("b", "who"), ("c", None)], "g string, fonte string"
    )
    assert {tuple(r) for r in lookup.single_sources(df, ["g"]).collect()} == {("a", "gbd"), ("b", None), ("c", None)}
    assert lookup.is_single_source(df.filter("g = 'a'"), "Gbd") and not lookup.is_single_source(df, "gbd")
    assert not lookup.is_single_source(df.filter("g = 'c'"), "gbd") and not lookup.is_single_source(df.limit(0), "gbd")


def test_strict_pivot_fails_on_a_duplicate(spark):
    df = spark.createDataFrame([("A", 1, "m", 1.0), ("A", 1, "m", 1.0)], "u string, t int, k string, v double")
    with pytest.raises(PySparkException, match="duplicate cell: A, 1, m"):
        panel.pivot_strict(df, ["u", "t"], "k", "v").collect()


def test_outer_panel_is_one_shuffle_and_checks_keys(spark):
    a = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "u string, t int, x double")
    b = spark.createDataFrame([("B", 1, 5.0), ("C", 2, 6.0)], "u string, t int, y double")
    c = spark.createDataFrame([("A", 1, 9.0)], "u string, t int, z double")
    wide = panel.outer_panel({"a": a, "b": b, "c": c}, ["u", "t"])
    assert {r["u"]: (r["x"], r["y"], r["z"]) for r in wide.collect()} == {
        "A": (1.0, None, 9.0), "B": (2.0, 5.0, None), "C": (None, 6.0, None)
    }
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    with pytest.raises(PySparkException, match="duplicate key"):
        panel.outer_panel({"a": a.union(a), "b": b}, ["u", "t"]).collect()
    with pytest.raises(ValueError, match="is in both"):
        panel.outer_panel({"a": a, "b": a}, ["u", "t"])


def test_left_join_needs_a_unique_right_side(spark):
    left = spark.createDataFrame([("A",), ("A",), ("Z",)], "u string")
    right = spark.createDataFrame([("A", 1.0, None)], "u string, x double, y string")
    rows = panel.left_many_to_one(left, right, ["u"]).orderBy("u").collect()
    assert [tuple(r) for r in rows] == [("A", 1.0, None), ("A", 1.0, None), ("Z", None, None)]
    twice = spark.createDataFrame([("A", 1.0, None), ("Q", 1.0, "x"), ("Q", 2.0, "y")], "u string, x double, y string")
    for use in USES:  # an unmatched duplicate fails too, whatever is done with the result
        with pytest.raises(quality.QualityError, match="not unique at Q"):
            use(panel.left_many_to_one(left, twice, ["u"]), "u")


def test_gates(spark):
    df = spark.createDataFrame([("A", 1, 0.5), ("A", 1, 1.5), ("B", 1, None)], "u string, t int, x double")
    with pytest.raises(quality.QualityError, match="u=A, t=1"):
        quality.assert_unique(df, ["u", "t"])
    with pytest.raises(quality.QualityError, match="outside"):
        quality.assert_ranges(df, {"x": (0.0, 1.0)})
    quality.assert_ranges(df, {"x": (0.0, 2.0)})
    with pytest.raises(quality.QualityError):
        quality.assert_not_empty(df.filter("false"))
    assert quality.filled_counts(df, ["x"]).first()["n_any"] == 2


ENTRIES = [("Brazil", "BRA"), ("Brasilia", "XXB"), ("Kenya", "KEN"), ("Kenia", "KEX"), ("Chad", "TCD"), ("Mali", "MLI")]


def test_cascade_order(spark):
    rows = [
        (" bra ", "Quênia", "gbd"),      # a valid code wins
        ("6.0", "nonsense", "gbd"),      # id
        ("99", "Brasil", "gbd"),         # unknown id: no name fallback
        ("x", "  QUENIA ", "gbd"),       # no id: alias by name
        ("6", "Brasil", "who"),          # ids only count in id sources
        (None, "World", "who"),          # known, not an entity
        (None, "Kenyaa", "who"),         # fuzzy
        (None, "Atlantis", "who"),
        (None, None, "who"),
    ]
    df = spark.createDataFrame(rows, "iso3 string, pais string, fonte string")
    ids = lookup.id_dimension(spark.createDataFrame([("6.0", "chn"), ("7", "PRK")], "location_id string, iso3 string"), "location_id", "iso3")
    aliases = lookup.alias_dimension(spark, COUNTRY_ALIASES)
    dictionary = spark.createDataFrame(ENTRIES, "entry string, code string")
    out = lookup.resolve_cascade(df, "iso3", "pais", aliases, ids, F.col("fonte") == "gbd", dictionary, 1)
    got = [(r["resolved"], r["match_method"]) for r in out.collect()]
    want = [
        ("BRA", "code"), ("CHN", "id"), (None, "unknown_id"), ("KEN", "alias"), ("BRA", "alias"), (None, "not_an_entity"),
        ("KEN", "fuzzy"), (None, "none"), (None, "none"),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert lookup.unresolved_report(out, ["fonte", "pais"]).count() == 4
    with pytest.raises(quality.QualityError, match="unresolved labels"):
        lookup.keep_resolved(out, ["fonte", "pais"], "fail")
    assert lookup.keep_resolved(out, ["pais"]).count() == 5


def test_id_dimension_is_checked(spark):
    twice = spark.createDataFrame([("1", "AAA"), ("1.0", "BBB")], "id string, code string")
    with pytest.raises(PySparkException, match="duplicate id"):
        lookup.id_dimension(twice, "id", "code").collect()
    bad = spark.createDataFrame([("1", "AA")], "id string, code string")
    with pytest.raises(PySparkException, match="bad code"):
        lookup.id_dimension(bad, "id", "code").collect()


@pytest.mark.parametrize("edits", [1, 2])
def test_fuzzy_finds_what_comparing_all_pairs_finds(spark, edits):
    rng = random.Random(edits)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(120)]
    entries = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(60)})
    names = spark.createDataFrame([(w,) for w in words * 3], "n string")
    dictionary = spark.createDataFrame([(e, e.upper()) for e in entries], "entry string, code string")
    got = {r["name_key"]: (r["fuzzy_edits"], r["fuzzy_entry"]) for r in lookup.fuzzy_lookup(names, "n", dictionary, edits).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    want = {}
    for w in set(words):
        best = min((distance(w, e), e) for e in entries)
        if best[0] <= edits:
            want[w] = best
    assert got == want


def test_vocabulary_and_items(spark):
    df = spark.createDataFrame([("Incidência",), ("Óbitos",), ("DALYs (long name)",), (None,)], "m string")
    from panelspark.functions.vocab import FOOD_ITEMS, MEASURES
    got = [r[0] for r in df.select(panel.canonical_measure(F.col("m"), MEASURES)).collect()]
    assert got == ["incidence", "deaths", "dalys_(long_name)", ""]
    items = spark.createDataFrame([(" Coffee  and Products",), ("TEA (including mate)",), ("Milk",)], "i string")
    assert [r[0] for r in items.select(panel.canonical_item(F.col("i"), FOOD_ITEMS)).collect()] == [
        "Coffee and products", "Tea (including mate)", None
    ]
    assert [r[0] for r in items.filter(panel.has_any_word(F.col("i"), ["coffee", "tea"])).collect()] == [" Coffee  and Products", "TEA (including mate)"]


def test_names_meet_by_words(spark):
    entries = [("Republic of Korea", "KOR"), ("Democratic People's Republic of Korea", "PRK"), ("Republic of Moldova", "MDA"),
               ("United Republic of Tanzania", "TZA"), ("Brazil", "BRA"), ("Bolivia (Plurinational State of)", "BOL")]
    dictionary = spark.createDataFrame(entries, "entry string, code string")
    said = ["Korea, Republic of", "KOREA, Democratic People's Republic of", "Moldova, Republic of", "Tanzania, United Republik of",
            "Bolivia, Plurinational State of", "Brasil", "Republic of", "of", "", None, "Atlantis", "Brazil Brazil"]
    names = spark.createDataFrame([(n,) for n in said], "n string")
    got = {r["name_key"]: (r["fuzzy_code"], r["fuzzy_score"]) for r in lookup.token_lookup(names, "n", dictionary).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "korea, republic of": "KOR", "korea, democratic people's republic of": "PRK", "moldova, republic of": "MDA",
        "tanzania, united republik of": "TZA", "bolivia, plurinational state of": "BOL", "brasil": "BRA", "brazil brazil": "BRA",
    }
    assert got["korea, republic of"][1] == 1.0 and 0.7 <= got["tanzania, united republik of"][1] < 1


def test_no_pair_above_the_threshold_is_lost(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}{chr(97 + j)}{k}" for i in range(4) for j in range(3) for k in range(3)]
    draw = lambda: " ".join(rng.choice(words, rng.integers(1, 6), p=np.arange(36, 0, -1) / 666))
    entries = sorted({draw() for _ in range(60)})
    said = sorted({draw() for _ in range(80)})
    dictionary = spark.createDataFrame([(e, str(i)) for i, e in enumerate(entries)], "entry string, code string")
    names = spark.createDataFrame([(n,) for n in said], "n string")
    for threshold in (0.3, 0.6, 0.9):
        got = {r["name_key"]: (r["fuzzy_entry"], r["fuzzy_score"]) for r in lookup.token_lookup(names, "n", dictionary, threshold, 0).collect()}
        held = Counter(t for e in entries for t in set(e.split()))
        weight = lambda t: np.log1p(len(entries) / held[t]) if held[t] else np.log1p(len(entries))
        want = {}
        for n in said:
            scores = []
            for e in entries:
                a, b = set(n.split()), set(e.split())
                scores.append((-round(sum(map(weight, a & b)) / sum(map(weight, a | b)), 12), e))
            if -min(scores)[0] >= threshold:
                want[n] = min(scores)[1], -min(scores)[0]
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_cascade_tries_words_last(spark):
    dictionary = spark.createDataFrame([("Republic of Korea", "KOR"), ("Kenya", "KEN")], "entry string, code string")
    rows = [("KEN", "x"), (None, "Kenia"), (None, "Korea, Republic of"), (None, "Kory")]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "code string, name string, _from_id string")
    aliases = lookup.alias_dimension(spark, {"Nobody": None})
    for score, method in ((None, "none"), (0.7, "tokens")):
        got = {r["name"]: r for r in lookup.resolve_cascade(df, "code", "name", aliases, dictionary=dictionary, token_score=score).collect()}
        assert [got[n]["match_method"] for n in ("x", "Kenia", "Korea, Republic of", "Kory")] == ["code", "fuzzy", method, "none"]
        assert {r["_from_id"] for r in got.values()} == {"kept"}
    assert got["Korea, Republic of"]["resolved"] == "KOR"
