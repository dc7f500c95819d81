"""The country x year study end to end: landed files -> panel -> index -> imputation -> models -> tables.

Every step is a composition of the operators; the vocabularies are defaults and can be replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import vocab
from panelspark.functions.numeric import row_sum, to_double, to_int
from panelspark.functions.text import code_key, collapse_spaces, slug_text
from panelspark.operators import (
    effects, fixed_effects, gee, impute, index, linear, lookup, mixed, panel, quality, schema,
)
from panelspark.sources import landed
from panelspark.sources.sinks import write_stage, write_table

KEYS = ["iso3", "ano"]
FOOD_CONTRACT = ["iso3", "pais", "ano", "item", "consumo_kg_capita", "unidade", "flag", "origem"]
COMPONENTS = ["x1_consumo_total", "x2_proporcao_muito_quente", "x3_classificacao_0_2"]


# ---- sources -------------------------------------------------------------------------------------------------------

def standardised(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Hand-downloaded files of one source on the common vocabulary."""
    return landed.read_folder(spark, folder, source, vocab.COLUMN_ALIASES)


def indicators(spark: SparkSession, folder: str, names: Mapping[str, str]) -> DataFrame:
    """Landed indicator payloads as long rows, named through ``name -> code``."""
    rows = landed.read_payloads(spark, folder)
    by_code = {code: name for name, code in names.items()}
    return rows.withColumn("nome_indicador", panel.map_values(F.col("indicador"), by_code))


def food_contract(
    raw: DataFrame, first: int, last: int, m49: DataFrame | None = None, review: str | None = None
) -> DataFrame:
    """Food-supply extract -> canonical rows; areas without a code drop out, duplicates and missing items abort.

    ``review`` names a folder for the table of areas that dropped out.
    """
    found = {k: schema.find_loose(raw.columns, names) for k, names in vocab.FOOD_HEADERS.items()}
    missing = [k for k in ("pais", "ano", "item", "valor") if found[k] is None]
    if missing:
        raise ValueError(f"food extract: missing columns {missing}; found {raw.columns}")
    if found["iso3"] is None and (found["m49"] is None or m49 is None):
        raise ValueError("food extract: neither a code column nor a numeric area code with its dimension")

    def column(name: str):
        return F.col(schema.quoted(found[name]))

    work = raw
    if found["elemento"]:
        work = work.filter(F.lower(F.trim(column("elemento"))) == vocab.FOOD_ELEMENT.lower())
    if found["iso3"]:
        work = work.withColumn("_code", lookup.valid_code(column("iso3")))
    else:
        work = lookup.padded_code_lookup(work, found["m49"], m49, "_code")
    rows = work.select(
        F.col("_code").alias("iso3"),
        F.trim(column("pais")).alias("pais"),
        to_int(column("ano")).alias("ano"),
        panel.canonical_item(column("item"), vocab.FOOD_ITEMS).alias("item"),
        to_double(column("valor")).alias("consumo_kg_capita"),
        (F.trim(column("unidade")) if found["unidade"] else F.lit("kg/cap")).alias("unidade"),
        (F.trim(column("flag")) if found["flag"] else F.lit(None).cast("string")).alias("flag"),
    )
    kept = panel.period_filter(rows, "ano", first, last, ["item", "consumo_kg_capita"])
    if review:
        lost = kept.filter(F.col("iso3").isNull()).groupBy("pais").agg(F.count(F.lit(1)).alias("n_rows"))
        write_table(lost, f"{review}/food_areas_without_code", ["pais"])
    kept = kept.filter(F.col("iso3").isNotNull())
    quality.assert_unique(kept, ["iso3", "ano", "item"], "food extract")
    return kept


def food_supply(candidates: Mapping[str, DataFrame]) -> DataFrame:
    """First non-empty canonical source, tagged with its origin; all items must occur."""
    chosen = landed.first_non_empty(candidates).select(*FOOD_CONTRACT)
    quality.assert_not_empty(chosen, "food supply")
    spark = chosen.sparkSession
    required = spark.createDataFrame([(v,) for v in vocab.FOOD_ITEMS.values()], "item string")
    absent = [r[0] for r in quality.missing_categories(chosen, "item", required).collect()]
    if absent:
        raise quality.QualityError(f"food supply: mandatory items missing: {sorted(absent)}")
    return chosen


def indicator_candidates(catalogue: DataFrame, themes: Mapping[str, str]) -> DataFrame:
    """Catalogue entries per theme, for review."""
    return panel.catalogue_search(catalogue, "IndicatorName", themes).select("tema", "IndicatorCode", "IndicatorName")


def components(spark: SparkSession, path: str) -> DataFrame:
    """Curated unit-level components: any delimiter, found by hints, checked for codes, ranges and uniqueness."""
    raw = landed.read_delimited(spark, path, bad_header=vocab.FUSED_HEADER)
    found = {name: schema.find_by_hints(raw.columns, hints) for name, hints in vocab.COMPONENT_HINTS.items()}
    missing = [name for name, column in found.items() if column is None]
    if missing:
        raise KeyError(f"{path}: missing columns {missing}; found {raw.columns}")
    rows = raw.select(
        code_key(F.col(schema.quoted(found["iso3"]))).alias("iso3"),
        *[to_double(F.col(schema.quoted(found[c]))).alias(c) for c in vocab.COMPONENT_RANGES],
    )
    bad = rows.filter(~F.coalesce(F.col("iso3").rlike(lookup.CODE_PATTERN), F.lit(False))).limit(10).collect()
    if bad:
        raise quality.QualityError(f"{path}: invalid codes {[r['iso3'] for r in bad]}")
    quality.assert_ranges(rows, vocab.COMPONENT_RANGES, path)
    return quality.assert_unique(rows, ["iso3"], path)


# ---- harmonise and build -------------------------------------------------------------------------------------------

def harmonised(
    df: DataFrame, id_source: str | None = None, ids: DataFrame | None = None, dictionary: DataFrame | None = None,
    review: str | None = None, file_name: str = "",
) -> DataFrame:
    """Rows with a resolved country code. A source keyed by location id must resolve in full; others drop the rest.

    ``review`` names a folder for the table of all unresolved labels, which is written before a strict source aborts.
    """
    absent = [c for c in ("iso3", "pais") if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in absent})
    strict = id_source is not None and lookup.is_single_source(df, id_source, file_name=file_name)
    aliases = lookup.alias_dimension(df.sparkSession, vocab.COUNTRY_ALIASES)
    resolved = lookup.resolve_cascade(
        df, "iso3", "pais", aliases, ids if strict else None, F.lit(strict), dictionary
    )
    labels = [c for c in ("fonte", "pais", "iso3") if c in df.columns]
    if review:
        write_table(lookup.unresolved_report(resolved, labels), f"{review}/unresolved_labels", labels)
    kept = lookup.keep_resolved(resolved, labels, "fail" if strict else "drop")
    return kept.withColumn("iso3", F.col("resolved")).drop("resolved", "match_method")


def outcomes(burden: DataFrame, measures: Sequence[str] | None = None) -> DataFrame:
    """Age-standardised rates of the cause, one ``asr_*`` column per measure."""
    rules = {"causa": vocab.CAUSE_WORDS, "metrica": vocab.METRIC_WORDS, "faixa_etaria": vocab.AGE_WORDS}
    schema.require_columns(burden, ["causa", "metrica", "medida", "valor", "ano"], "burden")
    kept = panel.keyword_filter(burden, rules, optional=["faixa_etaria"])
    rows = kept.select(
        "iso3", to_int(F.col("ano")).alias("ano"),
        panel.canonical_measure(F.col("medida"), vocab.MEASURES).alias("medida"), to_double(F.col("valor")).alias("valor"),
    )
    return panel.pivot_mean(rows, KEYS, "medida", "valor", measures, "asr_")


def covariates(rows: DataFrame, names: Sequence[str] | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Indicator columns; ``codes`` (column iso3) keeps aggregates such as world totals out."""
    typed = rows.select("iso3", to_int(F.col("ano")).alias("ano"), "nome_indicador", to_double(F.col("valor")).alias("valor"))
    if codes is not None:
        typed = typed.join(codes.select("iso3").distinct(), "iso3", "left_semi")
    return panel.pivot_mean(typed, KEYS, "nome_indicador", "valor", names)


def food_columns(food: DataFrame) -> DataFrame:
    """One column per food item; a duplicate cell fails."""
    rows = food.withColumns({"iso3": code_key(F.col("iso3")), "item": collapse_spaces(F.col("item"))})
    wide = panel.pivot_strict(rows, KEYS, "item", "consumo_kg_capita")
    names = {c: vocab.FOOD_COLUMNS.get(c, slug_text(c, "faostat_", "_kg_capita")) for c in wide.columns if c not in KEYS}
    return wide.withColumnsRenamed(names)


def health_columns(raw: DataFrame) -> DataFrame | None:
    """Health-observatory rows as ``who_*`` columns; None when the layout is not the expected one."""
    rows = landed.select_contract(raw, {"iso3": "SpatialDim", "ano": "TimeDim", "tema": "tema", "valor": "NumericValue"})
    if rows is None:
        return None
    typed = rows.withColumns({"ano": to_int(F.col("ano")), "valor": to_double(F.col("valor"))})
    return panel.pivot_mean(typed, KEYS, "tema", "valor", prefix="who_")


def country_year(parts: Mapping[str, DataFrame | None], first: int | None = None, last: int | None = None) -> DataFrame:
    """Full outer join of the available sources on (iso3, ano)."""
    present = {name: part for name, part in parts.items() if part is not None}
    if not present:
        raise RuntimeError("no source is available")
    wide = panel.outer_panel(present, KEYS)
    return wide if first is None or last is None else wide.filter(F.col("ano").between(first, last))


def with_index(wide: DataFrame, curated: DataFrame) -> index.IndexResult:
    """Add the consumption total, the curated components and the oriented first-component index."""
    consumption = schema.columns_with_prefix(wide, "faostat_")
    if not consumption:
        raise RuntimeError("no faostat_* column in the panel")
    joined = panel.left_many_to_one(wide, curated, ["iso3"])
    summed = joined.withColumn("x1_consumo_total", row_sum([F.col(schema.quoted(c)) for c in consumption]))
    return index.pca_index(summed, COMPONENTS, "iso3", orient=COMPONENTS[0])


# ---- analysis ------------------------------------------------------------------------------------------------------

def primary_models(
    imputed: DataFrame,
    covariate_names: Sequence[str],
    stratum: str,
    outcome: str = "asr_incidence",
    control: str = "asr_incidence_eac",
    secondary: Sequence[str] = ("asr_deaths", "asr_dalys", "asr_ylls", "asr_ylds"),
    exposure: str = "index",
) -> dict[str, DataFrame]:
    """Nested mixed model pooled over the copies; fixed effects, spline, control and GEE fits on the first copy."""
    terms = [exposure, *covariate_names]
    first = impute.completed(imputed, 1)
    fits = mixed.mixed_model(imputed, outcome, terms, "iso3", stratum, by="imp").coefficients
    pooled = impute.pool(fits).withColumn("p_value", impute.t_p_value("statistic", "df"))
    out = {
        "mixed_primary": pooled,
        "fixed_effects": fixed_effects.two_way_fixed_effects(first, outcome, terms, "iso3", "ano"),
    }
    knots = linear.spline_knots(first, exposure)
    out["spline"] = linear.spline_fit(first, outcome, exposure, covariate_names, knots)
    out["nonlinearity"] = linear.nonlinearity_test(first, outcome, exposure, covariate_names, knots)
    controls = mixed.control_outcomes(first, [control], terms, "iso3", stratum)
    if controls is not None:
        out["control"] = controls
    for name in schema.available(first, secondary):
        out[f"gee_{name}"] = gee.gee_ar1(first, name, terms, "iso3", "ano").coefficients
    sd = first.agg(F.stddev_samp(exposure).alias("sd")).scalar()
    out["e_value"] = effects.e_value(pooled.filter(F.col("term") == exposure), sd)
    return out


def sensitivity(
    wide: DataFrame,
    covariate_names: Sequence[str],
    stratum: str | None = None,
    outcome: str = "asr_incidence",
    exposure: str = "index",
    components_used: Sequence[str] = COMPONENTS,
) -> dict[str, DataFrame]:
    """Leave-one-country-out, slopes per stratum and the equal-weight index, on the panel before imputation."""
    out = {"leave_one_out": mixed.leave_one_out_mixed(wide, "iso3", outcome, exposure, covariate_names)}
    out["forest"] = effects.forest_table(out["leave_one_out"].select("iso3", "estimate"), "iso3")
    if stratum and stratum in wide.columns:
        out["strata"] = linear.stratified_slopes(wide, stratum, outcome, exposure)
    parts = schema.available(wide, components_used)
    if len(parts) >= 2:
        scored = index.equal_weight_index(wide, parts)
        fit = mixed.mixed_model(scored, outcome, ["index_equal", *covariate_names], "iso3")
        out["equal_weight"] = fit.coefficients
    return out


def descriptive(wide: DataFrame, outcome: str = "asr_incidence", exposure: str = "index") -> dict[str, DataFrame]:
    """Means per index quartile and the dose-response points."""
    wanted = ["tabagismo", "alcool", "frutas", "vegetais", "sdi"]
    summaries = [c for c in wide.columns if c.startswith("asr_") or c in wanted]
    out = {"dose_points": effects.dose_points(wide, exposure, outcome)}
    if summaries:
        out["quartiles"] = index.quantile_table(wide, exposure, summaries)
    return out


def save(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write result tables as delimited text, in the order of their leading column and keys."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", schema.available(df, KEYS) or df.columns[:1])


def save_stage(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage as Parquet in key order and go on from the files."""
    return write_stage(df, f"{folder}/{name}", partition_by, [*partition_by, *schema.available(df, KEYS)])
