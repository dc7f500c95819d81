import json
import random

import pytest

from panelspark.operators import impute, lookup
from panelspark.operators.quality import QualityError
from panelspark.plans import country_panel as cp

CODES = ["BRA", "KEN", "CHN", "DEU", "IRN", "TUR", "USA"]
NAMES = ["Brasil", "Quênia", "China", "Alemanha", "Irã", "Turquia", "Estados Unidos"]
YEARS = range(2010, 2016)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    rng = random.Random(5)
    cause, metric, age = "Câncer de Esôfago", "Taxa", "Idade padronizada"
    rows = ["location_id,location_name,year,measure_name,cause_name,metric_name,age_name,val"]
    for i, name in enumerate(NAMES):
        for year in YEARS:
            for measure in ("Incidência", "Óbitos"):
                rows.append(f"{i + 1}.0,{name},{year},{measure},{cause},{metric},{age},{rng.uniform(2, 9) + i:.4f}")
            rows.append(f"{i + 1},{name},{year},Incidência,Outra,{metric},{age},999")
    write(root / "gbd" / "a.csv", "\n".join(rows) + "\n")
    food = ["Area,Area Code (M49),Element,Item,Year,Unit,Value,Flag"]
    for i, name in enumerate(NAMES):
        for year in YEARS:
            for item in ("Coffee and  products", "Tea (including mate)"):
                food.append(f'{name},{i + 4},"Food supply quantity (kg/capita/yr)",{item},{year},kg,{rng.uniform(0, 5):.3f},E')
            food.append(f'{name},{i + 4},Other,Coffee and products,{year},kg,77,E')
    food.append('World,999,"Food supply quantity (kg/capita/yr)",Tea (including mate),2012,kg,1,E')
    write(root / "food.csv", "\n".join(food) + "\n")
    write(root / "m49.csv", "code,iso3\n" + "".join(f"{i + 4:03d},{c}\n" for i, c in enumerate(CODES)))
    write(root / "ids.csv", "location_id,iso3\n" + "".join(f"{i + 1},{c}\n" for i, c in enumerate(CODES)))
    for code, low in (("NY.GDP", 5.0), ("SP.URB", 1.0)):
        records = [
            {"countryiso3code": c, "country": {"value": c}, "date": str(y), "value": None if rng.random() < 0.15 else rng.uniform(low, 9)}
            for c in [*CODES, "WLD"] for y in YEARS
        ]
        write(root / "wb" / f"indicator={code}" / "p.json", json.dumps([{"page": 1}, records]))
    who = ["SpatialDim,TimeDim,NumericValue,tema"] + [f"{c},{y},{rng.uniform(1, 4):.3f},imc" for c in CODES for y in YEARS]
    write(root / "who.csv", "\n".join(who) + "\n")
    curated = ["iso3;pais;x2_proporcao_muito_quente;x3_classificacao_0_2"] + [
        f"{c};{n};{rng.uniform(0, 1):.2f};{i % 3}" for i, (c, n) in enumerate(zip(CODES, NAMES))
    ]
    write(root / "components.csv", "\n".join(curated) + "\n")
    return root


def test_study_from_files_to_tables(spark, landed, tmp_path):
    from panelspark.sources.landed import read_delimited

    ids = lookup.id_dimension(read_delimited(spark, str(landed / "ids.csv")), "location_id", "iso3")
    burden = cp.harmonised(cp.standardised(spark, str(landed / "gbd"), "gbd"), "gbd", ids)
    outcomes = cp.outcomes(burden)
    assert outcomes.columns == ["iso3", "ano", "asr_deaths", "asr_incidence"] and outcomes.count() == 42
    m49 = read_delimited(spark, str(landed / "m49.csv"))
    raw_food = read_delimited(spark, str(landed / "food.csv"))
    food = cp.food_supply({"manual": cp.food_contract(raw_food.filter("false"), 2010, 2015, m49), "api": cp.food_contract(raw_food, 2010, 2015, m49)})
    assert food.columns == cp.FOOD_CONTRACT and food.count() == 84 and food.first()["origem"] == "api"
    with pytest.raises(QualityError, match="mandatory"):
        cp.food_supply({"a": cp.food_contract(raw_food.filter("Item like 'Tea%'"), 2010, 2015, m49)})
    with pytest.raises(QualityError, match="duplicate"):
        cp.food_contract(raw_food.union(raw_food), 2010, 2015, m49)
    indicators = cp.indicators(spark, str(landed / "wb"), {"pib_per_capita": "NY.GDP", "urbanizacao_pct": "SP.URB"})
    codes = read_delimited(spark, str(landed / "ids.csv"))
    wide = cp.country_year({
        "gbd": outcomes,
        "world": cp.covariates(indicators, codes=codes),
        "food": cp.food_columns(food),
        "health": cp.health_columns(read_delimited(spark, str(landed / "who.csv"))),
    }, 2010, 2015)
    wide = cp.save_stage(wide, str(tmp_path), "panel")
    assert wide.count() == 42
    assert {"faostat_coffee_kg_capita", "faostat_tea_mate_kg_capita", "who_imc", "pib_per_capita", "asr_incidence"} <= set(wide.columns)
    result = cp.with_index(wide, cp.components(spark, str(landed / "components.csv")))
    assert result.diagnostics.count() == 3
    panel = cp.save_stage(result.panel.selectExpr("*", "if(iso3 < 'D', 'east', 'west') as region"), str(tmp_path), "indexed")
    names = ["urbanizacao_pct"]
    imputed = impute.mice(panel, ["iso3", "ano"], ["asr_incidence", "asr_deaths", "index", "urbanizacao_pct"], m=2, iterations=1, carry=["region"])
    imputed = cp.save_stage(imputed, str(tmp_path), "imputed", ["imp"])
    tables = cp.primary_models(imputed, names, "region")
    tables |= cp.sensitivity(panel.dropna(subset=names), names, "region")
    tables |= cp.descriptive(panel)
    assert set(tables) == {
        "mixed_primary", "fixed_effects", "spline", "nonlinearity", "gee_asr_deaths", "e_value",
        "leave_one_out", "forest", "strata", "equal_weight", "dose_points", "quartiles",
    }
    cp.save({k: tables[k] for k in ("mixed_primary", "quartiles")}, str(tmp_path / "tables"))
    assert {r["term"] for r in tables["mixed_primary"].collect()} == {"(Intercept)", "index", "urbanizacao_pct"}
    assert tables["leave_one_out"].filter("status = 'ok'").count() == 7
    assert tables["quartiles"].count() == 4 and tables["e_value"].first()["e_value"] >= 1


def test_a_file_without_an_age_column_keeps_its_rows(spark, tmp_path):
    head = "location_name,year,measure_name,cause_name,metric_name,val"
    write(tmp_path / "in" / "a.csv", f"{head}\nBrasil,2010,Incidência,Câncer de Esôfago,Taxa,2.5\nKenya?,2010,Incidência,Câncer de Esôfago,Taxa,1\n")
    rows = cp.standardised(spark, str(tmp_path / "in"), "who")
    assert "faixa_etaria" not in rows.columns and "iso3" not in rows.columns
    kept = cp.harmonised(rows, review=str(tmp_path / "review"))
    assert [tuple(r) for r in cp.outcomes(kept).collect()] == [("BRA", 2010, 2.5)]
    review = spark.read.option("header", True).csv(str(tmp_path / "review" / "unresolved_labels")).collect()
    assert [r["pais"] for r in review] == ["Kenya?"]
    aged = f"{head},age_name\nBrasil,2011,Incidência,Câncer de Esôfago,Taxa,2.5,Idade padronizada\nBrasil,2012,Incidência,Câncer de Esôfago,Taxa,9,5-9\n"
    write(tmp_path / "in" / "b.csv", aged)
    both = cp.outcomes(cp.harmonised(cp.standardised(spark, str(tmp_path / "in"), "who")))
    assert [tuple(r) for r in both.collect()] == [("BRA", 2011, 2.5)]  # with a column in one file, the rule holds


def test_the_file_name_makes_a_source_strict(spark):
    df = spark.createDataFrame([("1", "Nowhere", "x")], "iso3 string, pais string, fonte string")
    assert lookup.is_single_source(df, "gbd", file_name="GBD_2021.csv") and not lookup.is_single_source(df, "gbd")


def test_an_unknown_id_aborts(spark, landed):
    ids = lookup.id_dimension(spark.createDataFrame([("1", "BRA")], "location_id string, iso3 string"), "location_id", "iso3")
    with pytest.raises(QualityError, match="unresolved"):
        cp.harmonised(cp.standardised(spark, str(landed / "gbd"), "gbd"), "gbd", ids)


def test_components_are_checked(spark, tmp_path):
    head = "iso3,x2_proporcao_muito_quente,x3_classificacao_0_2\n"
    for body, error in (("BRA,1.5,0\n", "outside"), ("BR,0.5,0\n", "invalid codes"), ("BRA,0.5,0\nbra,0.4,1\n", "duplicate")):
        write(tmp_path / "c.csv", head + body)
        with pytest.raises(QualityError, match=error):
            cp.components(spark, str(tmp_path / "c.csv"))
