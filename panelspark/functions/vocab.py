"""Default vocabularies of the country-panel flow. Every operator takes its own instead."""

# Target column -> source column names, in order of preference.
COLUMN_ALIASES: dict[str, list[str]] = {
    "iso3": ["location_iso3", "iso3", "ISO3", "location_id", "Code"],
    "pais": ["location_name", "location", "Country", "pais", "Location"],
    "ano": ["year", "Year", "date", "ano"],
    "medida": ["measure_name", "measure", "Measure"],
    "causa": ["cause_name", "cause", "Cause"],
    "metrica": ["metric_name", "metric", "Metric"],
    "sexo": ["sex_name", "sex", "Sex"],
    "faixa_etaria": ["age_name", "age", "Age"],
    "valor": ["val", "value", "Value", "valor"],
    "limite_inferior": ["lower", "Lower", "ci_lower"],
    "limite_superior": ["upper", "Upper", "ci_upper"],
}

# Country spelling -> code; None marks a known aggregate.
COUNTRY_ALIASES: dict[str, str | None] = {
    "Russia": "RUS", "Russian Federation": "RUS",
    "South Korea": "KOR", "Korea, Rep.": "KOR", "Republic of Korea": "KOR",
    "North Korea": "PRK", "Korea, Dem. People's Rep.": "PRK",
    "Iran": "IRN", "Iran, Islamic Rep.": "IRN", "Iran (Islamic Republic of)": "IRN",
    "Vietnam": "VNM", "Viet Nam": "VNM",
    "Turkiye": "TUR", "Turkey": "TUR",
    "Laos": "LAO", "Lao PDR": "LAO",
    "Syria": "SYR", "Syrian Arab Republic": "SYR",
    "Tanzania": "TZA", "United Republic of Tanzania": "TZA",
    "Bolivia": "BOL", "Bolivia (Plurinational State of)": "BOL",
    "Venezuela": "VEN", "Venezuela (Bolivarian Republic of)": "VEN",
    "Moldova": "MDA", "Republic of Moldova": "MDA",
    "Brunei": "BRN", "Brunei Darussalam": "BRN",
    "Cote d'Ivoire": "CIV", "Côte d’Ivoire": "CIV", "Ivory Coast": "CIV",
    "Cabo Verde": "CPV", "Cape Verde": "CPV",
    "Democratic Republic of Congo": "COD", "Democratic Republic of the Congo": "COD",
    "Congo, Dem. Rep.": "COD", "Congo, Rep.": "COG",
    "Micronesia": "FSM", "Micronesia (Federated States of)": "FSM",
    "Eswatini": "SWZ", "Swaziland": "SWZ",
    "United States": "USA", "United States of America": "USA",
    "United Kingdom": "GBR",
    "Egypt": "EGY", "Egypt, Arab Rep.": "EGY",
    "Slovak Republic": "SVK",
    "Czechia": "CZE", "Czech Republic": "CZE",
    "Hong Kong": "HKG", "Hong Kong SAR, China": "HKG", "China, Hong Kong SAR": "HKG",
    "Macao": "MAC", "Macao SAR, China": "MAC", "China, Macao SAR": "MAC",
    "Taiwan": "TWN", "China, Taiwan Province of": "TWN",
    "Palestine": "PSE", "State of Palestine": "PSE", "West Bank and Gaza": "PSE",
    "Irã": "IRN", "Quênia": "KEN", "Brasil": "BRA", "Alemanha": "DEU",
    "Afeganistão": "AFG", "Argélia": "DZA", "Arábia Saudita": "SAU",
    "África do Sul": "ZAF", "Estados Unidos": "USA", "Reino Unido": "GBR",
    "Coreia do Sul": "KOR", "Coreia do Norte": "PRK", "Costa do Marfim": "CIV",
    "República Democrática do Congo": "COD", "República Tcheca": "CZE",
    "Tanzânia": "TZA", "Turquia": "TUR", "Vietnã": "VNM",
    "Global": None, "World": None,
}

# Keywords that select the outcome rows.
CAUSE_WORDS = ["esophageal", "esofago"]
METRIC_WORDS = ["rate", "taxa"]
AGE_WORDS = ["standardiz", "padronizada"]

# Measure label -> canonical measure.
MEASURES: dict[str, str] = {
    "incidencia": "incidence",
    "incidence": "incidence",
    "obitos": "deaths",
    "deaths": "deaths",
    "mortality": "deaths",
    "mortalidade": "deaths",
    "dalys": "dalys",
    "ylls": "ylls",
    "ylds": "ylds",
    "prevalencia": "prevalence",
    "prevalence": "prevalence",
}

# Food item key -> canonical item, and canonical item -> panel column.
FOOD_ITEMS: dict[str, str] = {
    "coffee and products": "Coffee and products",
    "tea (including mate)": "Tea (including mate)",
}
FOOD_COLUMNS: dict[str, str] = {
    "Coffee and products": "faostat_coffee_kg_capita",
    "Tea (including mate)": "faostat_tea_mate_kg_capita",
}
FOOD_ELEMENT = "Food supply quantity (kg/capita/yr)"

# Accepted header names of a food-supply extract.
FOOD_HEADERS: dict[str, tuple[str, ...]] = {
    "pais": ("Area", "pais", "Country"),
    "iso3": ("iso3", "Area Code (ISO3)", "ISO3 Code"),
    "m49": ("Area Code (M49)", "M49 Code"),
    "ano": ("Year", "ano"),
    "item": ("Item", "item"),
    "valor": ("Value", "valor", "consumo_kg_capita"),
    "unidade": ("Unit", "unidade"),
    "elemento": ("Element", "elemento"),
    "flag": ("Flag", "flag"),
}

# The curated component columns, the hints that find them, and their allowed ranges.
COMPONENT_HINTS: dict[str, tuple[str, ...]] = {
    "iso3": ("iso3",),
    "x2_proporcao_muito_quente": ("x2", "proporcao"),
    "x3_classificacao_0_2": ("x3", "classific"),
}
COMPONENT_RANGES = {"x2_proporcao_muito_quente": (0.0, 1.0), "x3_classificacao_0_2": (0.0, 2.0)}
FUSED_HEADER = "x2_metodo_afericaox3_classificacao_0_2"

# Texts that a delimited file uses for "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
