"""Registered queries of the data side: sources, schema resolution, look-ups, gates, pivots and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.numeric import row_sum, to_double, to_int
from panelspark.functions.text import code_key, name_key, plain_lower, slug
from panelspark.operators import lookup, panel, quality, schema
from panelspark.operators.ranking import running_count
from panelspark.operators.schema import alias_project
from panelspark.plans.registry import q6, query, r6
from panelspark.plans.views import (
    COMPONENTS, EVENT_TYPES, USER_DAY, USER_DAY_WIDE, table, user_day, user_day_wide,
)
from panelspark.session import shared_folder
from panelspark.sources import landed
from panelspark.sources.sinks import write_stage, write_table


# ---- sources -------------------------------------------------------------------------------------------------------

def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload text per event, with two records; small values stand for an answer without records."""
    events = table(spark, sf_dir, "events")
    year = F.year("ts").cast("string")
    head = F.concat(
        F.lit('{"countryiso3code":"U'), F.col("user_id").cast("string"), F.lit('","country":{"value":"'),
        F.col("event_type"), F.lit('"},"date":"'), year, F.lit('","value":'),
    )
    records = F.concat(
        F.lit('[{"page":1},['), head, F.col("value").cast("string"), F.lit("},"), head,
        F.get_json_object("props", "$.k"), F.lit("}]]"),
    )
    payload = F.when(F.col("value") < 5, F.lit('[{"page":1}]')).when(F.col("value") < 10, F.lit('[{"page":1},null]'))
    return events.select("event_type", payload.otherwise(records).alias("payload"))


@query("json_flatten", """
WITH e AS (SELECT *, CAST(year(ts) AS INTEGER) AS ano FROM events WHERE value >= 10)
SELECT 'U' || user_id AS iso3, event_type AS pais, ano, event_type AS indicador, value AS valor FROM e
UNION ALL
SELECT 'U' || user_id, event_type, ano, event_type, CAST(json_extract(props, '$.k') AS DOUBLE) FROM e""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.flatten_payload(event_payloads(spark, sf_dir), "payload", F.col("event_type"))


PARTY_ALIASES = {
    "code": ["party_id", "c_custkey", "s_suppkey"],
    "name": ["C_NAME", "c_name", "s_name"],
    "nation": ["c_nationkey", "s_nationkey"],
    "segment": ["c_mktsegment"],
    "balance": ["c_acctbal", "s_acctbal"],
}


@query("folder_union", """
SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
       c_acctbal AS balance, 'parties' AS fonte FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, s_nationkey, NULL, s_acctbal, 'parties' FROM supplier""")
def folder_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    for name in ("customer", "supplier"):
        table(spark, sf_dir, name).write.mode("append").option("header", True).csv(folder)
    texts = landed.read_folder(spark, folder, "parties", PARTY_ALIASES)
    return texts.withColumns({"nation": to_int(F.col("nation")), "balance": to_double(F.col("balance"))})


@query("union_tagged", """
SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS nome_indicador FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return landed.union_tagged({
        "customer": customer.select(
            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
        ),
        "supplier": supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
    })


@query("source_preference", """
SELECT o_orderkey AS key, o_totalprice AS amount, 'orders' AS origem FROM orders""")
def source_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return landed.first_non_empty({
        "returns": lineitem.filter("l_quantity < 0").select(
            F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount")
        ),
        "orders": orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")),
    })


# ---- schema, coercion, filters, vocabularies -----------------------------------------------------------------------

@query("alias_project", """
SELECT p_partkey AS code, p_name AS name, p_brand AS brand, CAST(NULL AS VARCHAR) AS region, 'part' AS fonte FROM part""")
def alias_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = {"code": ["part_id", "p_partkey", "p_size"], "name": ["P_NAME", "p_name"], "brand": ["p_brand"], "region": ["zone"]}
    return alias_project(table(spark, sf_dir, "part"), aliases, "part", keep_absent=True)


@query("coerce_numeric", """
SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN NULL ELSE c_acctbal END AS value,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN NULL ELSE CAST(trunc(c_acctbal) AS INTEGER) END AS whole,
       c_mktsegment AS code
FROM customer""")
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    text = F.when(segment == "HOUSEHOLD", "n/a").when(segment == "MACHINERY", "NaN").otherwise(
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))
    )
    work = table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"), F.concat(F.lit(" "), F.lower(segment)).alias("seg"))
    return work.select("c_custkey", to_double(F.col("text")).alias("value"), to_int(F.col("text")).alias("whole"), code_key(F.col("seg")).alias("code"))


THEMES = {"rings": "Ring", "blue goods": "BLUE", "anvils": "anvil"}


@query("catalogue_search", """
SELECT p_partkey, p_name, tema FROM part
JOIN (VALUES ('rings', 'ring'), ('blue goods', 'blue'), ('anvils', 'anvil')) t(tema, word) ON contains(lower(p_name), word)""")
def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.catalogue_search(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", THEMES)


@query("keyword_filter", """
SELECT p_partkey, p_type FROM part
WHERE (contains(p_name, 'ring') OR contains(p_name, 'gizmo')) AND (contains(lower(p_type), 'econ') OR contains(lower(p_type), 'small'))""")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("label", F.translate(F.upper("p_name"), "AEIOU", "ÁÊÍÖÜ"))
    rules = {"label": ["ring", "gizmo"], "p_type": ["econ", "small"], "age": ["standard"]}
    return panel.keyword_filter(part, rules, optional=["age"]).select("p_partkey", "p_type")


@query("text_normalise", """
SELECT doc_id, md5(strip_accents(lower(text))) AS plain_md5,
       md5(replace(trim(regexp_replace(strip_accents(lower(text)), '\\s+', ' ', 'g')), 'ß', 'ss')) AS key_md5
FROM documents""")
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(plain_lower(text)).alias("plain_md5"), F.md5(name_key(text)).alias("key_md5")
    )


@query("period_filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' AND o_totalprice IS NOT NULL""")
def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-12-31"))
    orders = panel.period_filter(table(spark, sf_dir, "orders"), "o_orderdate", first, last, ["o_totalprice"])
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


ITEMS = {"economy": "Economy goods", "small": "Small goods", "promo pack": "Promotional goods"}


@query("item_canonical", """
SELECT * FROM (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy goods' WHEN 'SMALL' THEN 'Small goods'
                               WHEN 'PROMO' THEN 'Promotional goods' END AS item FROM part
) WHERE item IS NOT NULL""")
def item_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("p_type") == "PROMO", F.lit("\tPromo   PACK ")).otherwise(F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
    part = table(spark, sf_dir, "part").select("p_partkey", panel.canonical_item(label, ITEMS).alias("item"))
    return part.filter(F.col("item").isNotNull())


ACTIONS = {"click rate": "interaction", "view rate": "interaction", "purchase rate": "sale"}


@query("measure_vocab", """
SELECT CASE WHEN event_type IN ('click', 'view') THEN 'interaction' WHEN event_type = 'purchase' THEN 'sale'
            ELSE event_type || '_rate' END AS measure,
       'm_' || event_type || '_rate_total' AS slug, count(*) AS n_rows
FROM events GROUP BY 1, 2""")
def measure_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.initcap("event_type"), F.lit(" Rate"))
    work = table(spark, sf_dir, "events").select(
        panel.canonical_measure(label, ACTIONS).alias("measure"),
        slug(F.concat(F.lit("("), label, F.lit(")")), "m_", "_total").alias("slug"),
    )
    return work.groupBy("measure", "slug").agg(F.count(F.lit(1)).alias("n_rows"))


@query("min_size_units", """
SELECT s_suppkey, s_nationkey FROM supplier
WHERE s_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING sum(greatest(c_acctbal, 0)) >= 250000)""")
def min_size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("s_nationkey"), F.greatest("c_acctbal", F.lit(0.0)).alias("size")
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return panel.min_size_units(supplier, "s_nationkey", sizes, "size", 250000).select("s_suppkey", "s_nationkey")


# ---- look-ups ------------------------------------------------------------------------------------------------------

NATION_CODE = "^NATION_[0-9]+$"


@query("id_lookup", """
SELECT c_custkey, n_name AS code FROM customer
LEFT JOIN nation ON n_nationkey = CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END""")
def id_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = lookup.id_dimension(table(spark, sf_dir, "nation"), "n_nationkey", "n_name", NATION_CODE)
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("unknown")).otherwise(F.concat(F.col("c_nationkey"), F.lit(".0")))
    customer = table(spark, sf_dir, "customer").select("c_custkey", text.alias("id_text"))
    return lookup.id_lookup(customer, "id_text", dim, "code").select("c_custkey", "code")


@query("padded_code_lookup", """
SELECT s_suppkey, n_name AS code FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_acctbal >= 0""")
def padded_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "nation").select(F.format_string("%03d", "n_nationkey").alias("padded"), "n_name")
    text = F.when(F.col("s_acctbal") < 0, F.concat(F.lit("9000"), F.col("s_nationkey"))).otherwise(
        F.concat(F.lit(" "), F.col("s_nationkey"), F.lit(".0"))
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("code_text"))
    return lookup.padded_code_lookup(supplier, "code_text", dim, "code").select("s_suppkey", "code")


def labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a raw code and an imperfect nation label; the market segment decides the kind of flaw."""
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    segment, name = F.col("c_mktsegment"), F.col("n_name")
    label: Column = (
        F.when(segment == "HOUSEHOLD", F.concat(F.lit("  "), F.translate(name, "AI", "ÁÎ"), F.lit(" ")))
        .when(segment == "MACHINERY", F.replace(name, F.lit("NATION"), F.lit("Natiom")))
        .when(segment == "FURNITURE", F.lit("World"))
        .when(segment == "BUILDING", F.concat(F.lit("Lost  isle "), F.col("c_nationkey")))
        .otherwise(F.lower(name))
    )
    raw = (
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit(" n"), F.substring(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), 1, 2)))
        .when(F.col("c_acctbal") > 5000, F.concat(F.col("c_nationkey") + 1, F.lit(".0")))
    )
    return customer.select("c_custkey", segment.alias("fonte"), raw.alias("raw_code"), label.alias("label"))


LABELLED = """
lab AS (
  SELECT c_custkey, c_mktsegment AS fonte, n_name, c_nationkey,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '  ' || translate(n_name, 'AI', 'ÁÎ') || ' '
              WHEN 'MACHINERY' THEN replace(n_name, 'NATION', 'Natiom') WHEN 'FURNITURE' THEN 'World'
              WHEN 'BUILDING' THEN 'Lost  isle ' || c_nationkey ELSE lower(n_name) END AS label,
         CASE WHEN c_acctbal < 0 THEN ' n' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
              WHEN c_acctbal > 5000 THEN (c_nationkey + 1) || '.0' END AS raw_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def nation_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("alias"), short_code(F.col("n_nationkey")).alias("code"))
    extra = spark.createDataFrame([("WORLD", None), ("Global", None)], "alias string, code string")
    return lookup.alias_dimension(spark, nation.unionByName(extra))


def short_code(key: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))


SHORT_CODE = "^N[0-9]{2}$"


def short_sql(key: str) -> str:
    return f"'N' || lpad(CAST({key} AS VARCHAR), 2, '0')"


@query("alias_lookup", f"""
WITH {LABELLED}
SELECT c_custkey, CASE WHEN fonte IN ('HOUSEHOLD', 'AUTOMOBILE') THEN {short_sql('c_nationkey')} END AS code,
       fonte IN ('HOUSEHOLD', 'AUTOMOBILE', 'FURNITURE') AS code_known FROM lab""")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.alias_lookup(labelled_customers(spark, sf_dir), "label", nation_aliases(spark, sf_dir), "code")
    return found.select("c_custkey", "code", "code_known")


def nation_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("entry"), short_code(F.col("n_nationkey")).alias("code"))


@query("fuzzy_lookup", f"""
WITH {LABELLED},
names AS (SELECT DISTINCT lower(strip_accents(trim(regexp_replace(label, '\\s+', ' ', 'g')))) AS name_key FROM lab),
scored AS (
  SELECT name_key, n_name AS entry, {short_sql('n_nationkey')} AS code, levenshtein(name_key, lower(n_name)) AS edits
  FROM names, nation
),
best AS (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY edits, entry) AS pos FROM scored WHERE edits <= 2)
SELECT name_key, entry AS fuzzy_entry, code AS fuzzy_code, CAST(edits AS INTEGER) AS fuzzy_edits,
       {q6('1.0 - CAST(edits AS DOUBLE) / greatest(length(name_key), length(entry))')} AS fuzzy_score
FROM best WHERE pos = 1""")
def fuzzy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.fuzzy_lookup(labelled_customers(spark, sf_dir), "label", nation_dictionary(spark, sf_dir), max_edits=2)
    return found.withColumn("fuzzy_score", r6("fuzzy_score"))


@query("token_lookup", f"""
WITH said AS (
  SELECT DISTINCT lower(CASE c_custkey % 5 WHEN 0 THEN r_name || ', ' || n_name || ' (the)' WHEN 1 THEN n_name || ' in ' || r_name
    WHEN 2 THEN replace(n_name, 'A', 'AA') || ' / ' || r_name WHEN 3 THEN 'customer of ' || c_custkey
    ELSE r_name || ' ' || n_name END) AS name_key
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
entries AS (SELECT n_name || ' of ' || r_name AS entry, {short_sql('n_nationkey')} AS code FROM nation JOIN region ON n_regionkey = r_regionkey),
held AS (SELECT entry, code, unnest(list_distinct(list_filter(string_split_regex(lower(entry), '[^a-z0-9]+'), lambda t: t <> ''))) AS token FROM entries),
total AS (SELECT count(*)::DOUBLE AS n FROM entries),
weights AS (SELECT token, ln(1 + any_value(n) / count(*)) AS weight FROM held, total GROUP BY token),
spoken AS (SELECT name_key, unnest(list_distinct(list_filter(string_split_regex(name_key, '[^a-z0-9]+'), lambda t: t <> ''))) AS word FROM said),
near AS (
  SELECT word, token, weight, levenshtein(word, token) AS edits FROM (SELECT DISTINCT word FROM spoken), weights
  WHERE levenshtein(word, token) <= CASE WHEN least(length(word), length(token)) >= 4 THEN 2 ELSE 0 END
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY levenshtein(word, token), token) = 1),
known AS (
  SELECT name_key, coalesce(token, word) AS token, max(coalesce(weight, ln(1 + n))) AS weight,
         max(coalesce(1 - edits::DOUBLE / greatest(length(word), length(token)), 0)) AS quality
  FROM spoken LEFT JOIN near USING (word), total GROUP BY 1, 2),
mine AS (SELECT name_key, sum(weight) AS mw FROM known GROUP BY 1),
theirs AS (SELECT entry, code, sum(weight) AS tw FROM held JOIN weights USING (token) GROUP BY 1, 2),
pairs AS (
  SELECT name_key, entry, code, sum(known.weight * quality) AS agreed, sum(known.weight) AS shared
  FROM known JOIN held USING (token) GROUP BY 1, 2, 3),
scored AS (SELECT *, agreed / (mw + tw - shared) AS score FROM pairs JOIN mine USING (name_key) JOIN theirs USING (entry, code))
SELECT name_key, entry AS fuzzy_entry, code AS fuzzy_code, {q6('score')} AS fuzzy_score FROM scored WHERE score >= 0.6
QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY round(score, 12) DESC, entry) = 1""")
def token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations named with their regions in other orders, with other words and slips, against one list of entries."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    customers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    kind, n, r = F.col("c_custkey") % 5, F.col("n_name"), F.col("r_name")
    said = (
        F.when(kind == 0, F.concat(r, F.lit(", "), n, F.lit(" (the)"))).when(kind == 1, F.concat(n, F.lit(" in "), r))
        .when(kind == 2, F.concat(F.replace(n, F.lit("A"), F.lit("AA")), F.lit(" / "), r))
        .when(kind == 3, F.concat(F.lit("customer of "), F.col("c_custkey").cast("string"))).otherwise(F.concat(r, F.lit(" "), n))
    )
    entries = places.select(F.concat(n, F.lit(" of "), r).alias("entry"), short_code(F.col("n_nationkey")).alias("code"))
    found = lookup.token_lookup(customers.select(said.alias("label")), "label", entries, threshold=0.6, max_edits=2)
    return found.withColumn("fuzzy_score", r6("fuzzy_score"))


def cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lookup.id_dimension(
        table(spark, sf_dir, "nation").withColumn("code", short_code(F.col("n_nationkey"))), "n_nationkey", "code", SHORT_CODE
    )
    return lookup.resolve_cascade(
        labelled_customers(spark, sf_dir), "raw_code", "label", nation_aliases(spark, sf_dir), ids,
        F.col("fonte").isin("HOUSEHOLD", "BUILDING"), nation_dictionary(spark, sf_dir), 1, SHORT_CODE,
    )


CASCADE = f"""
{LABELLED},
res AS (
  SELECT *, CASE
    WHEN upper(trim(raw_code)) ~ '^N[0-9]{{2}}$' THEN 'code'
    WHEN raw_code IS NOT NULL AND fonte IN ('HOUSEHOLD', 'BUILDING') THEN CASE WHEN c_nationkey + 1 < 25 THEN 'id' ELSE 'unknown_id' END
    WHEN fonte IN ('HOUSEHOLD', 'AUTOMOBILE') THEN 'alias' WHEN fonte = 'FURNITURE' THEN 'not_an_entity'
    WHEN fonte = 'MACHINERY' THEN 'fuzzy' ELSE 'none' END AS match_method
  FROM lab
),
rr AS (
  SELECT *, CASE match_method WHEN 'code' THEN upper(trim(raw_code)) WHEN 'id' THEN {short_sql('c_nationkey + 1')}
                 WHEN 'alias' THEN {short_sql('c_nationkey')} WHEN 'fuzzy' THEN {short_sql('c_nationkey')} END AS resolved
  FROM res
)"""


@query("resolve_cascade", f"WITH {CASCADE} SELECT c_custkey, match_method, resolved FROM rr")
def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(spark, sf_dir).select("c_custkey", "match_method", "resolved")


@query("unresolved_report", f"""
WITH {CASCADE} SELECT fonte, label, raw_code, count(*) AS n_rows FROM rr WHERE resolved IS NULL GROUP BY 1, 2, 3""")
def unresolved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.unresolved_report(cascade(spark, sf_dir), ["fonte", "label", "raw_code"])


# ---- quality gates -------------------------------------------------------------------------------------------------

@query("dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


RANGES = {"l_discount": (0.0, 0.05), "l_quantity": (5.0, 40.0), "l_tax": (0.0, 0.08)}


@query("range_violations", """
SELECT 'l_discount' AS column_name, count(l_discount) AS n_values, count(*) FILTER (l_discount NOT BETWEEN 0 AND 0.05) AS n_outside FROM lineitem
UNION ALL SELECT 'l_quantity', count(l_quantity), count(*) FILTER (l_quantity NOT BETWEEN 5 AND 40) FROM lineitem
UNION ALL SELECT 'l_tax', count(l_tax), count(*) FILTER (l_tax NOT BETWEEN 0 AND 0.08) FROM lineitem""")
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_violations(table(spark, sf_dir, "lineitem"), RANGES)


@query("missing_categories", """
SELECT category FROM (VALUES ('click'), ('refund'), ('signup'), ('download')) t(category)
WHERE category NOT IN (SELECT event_type FROM events)""")
def missing_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = spark.createDataFrame([("click",), ("refund",), ("signup",), ("download",)], "category string")
    return quality.missing_categories(table(spark, sf_dir, "events"), "event_type", required)


@query("coverage_profile", f"""
WITH {USER_DAY} SELECT count(*) AS n_rows, count(DISTINCT unit) AS n_units, min(period) AS first_period,
max(period) AS last_period, count(DISTINCT measure) AS n_categories FROM ud""")
def coverage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage_profile(user_day(spark, sf_dir), "unit", "period", "measure")


@query("null_profile", f"WITH {USER_DAY_WIDE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM uw" for c in EVENT_TYPES))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(user_day_wide(spark, sf_dir), EVENT_TYPES)


@query("missing_pattern", f"WITH {USER_DAY_WIDE} SELECT " + ", ".join(
    f"CAST({c} IS NOT NULL AS INTEGER) AS {c}" for c in EVENT_TYPES) + ", count(*) AS n_rows, " + " + ".join(
    f"CAST({c} IS NULL AS INTEGER)" for c in EVENT_TYPES) + " AS n_missing FROM uw GROUP BY ALL")
def missing_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_pattern(user_day_wide(spark, sf_dir), EVENT_TYPES)


@query("filled_counts", f"""
WITH {USER_DAY_WIDE} SELECT count(coalesce(click, error, view)) AS n_any, count(click) AS n_click, count(error) AS n_error,
count(view) AS n_view FROM uw""")
def filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filled_counts(user_day_wide(spark, sf_dir), COMPONENTS)


# ---- pivots and panel joins ----------------------------------------------------------------------------------------

@query("pivot_mean", f"WITH {USER_DAY_WIDE} SELECT unit, period, " + ", ".join(
    f"{q6(c)} AS m_{c}" for c in EVENT_TYPES) + " FROM uw")
def pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.pivot_mean(user_day(spark, sf_dir), ["unit", "period"], "measure", "value", prefix="m_")
    return wide.select("unit", "period", *[r6(f"m_{c}").alias(f"m_{c}") for c in EVENT_TYPES])


@query("pivot_strict", f"WITH {USER_DAY} SELECT unit, period, " + ", ".join(
    f"{q6(f'''max(value) FILTER (measure = '{c}')''')} AS {c}" for c in EVENT_TYPES) + " FROM ud GROUP BY unit, period")
def pivot_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = user_day(spark, sf_dir).groupBy("unit", "period", "measure").agg(F.max("value").alias("top"))
    wide = panel.pivot_strict(cells, ["unit", "period"], "measure", "top", EVENT_TYPES)
    return wide.select("unit", "period", *[r6(c).alias(c) for c in EVENT_TYPES])


@query("row_sum_min1", f"""
WITH {USER_DAY_WIDE} SELECT unit, period, CASE WHEN coalesce(click, error, view) IS NOT NULL
THEN {q6('coalesce(click, 0) + coalesce(error, 0) + coalesce(view, 0)')} END AS total FROM uw""")
def row_sum_min1(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = row_sum([F.col(c) for c in COMPONENTS])
    return user_day_wide(spark, sf_dir).select("unit", "period", r6(total).alias("total"))


@query("left_m2o", """
SELECT s_suppkey, s_name, s_nationkey, n_name, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def left_m2o(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return panel.left_many_to_one(supplier, nation, ["s_nationkey"])


def outer_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders by customer and events by user, over calendar months: neither side has all ids and months of the other."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    demand = orders.groupBy(F.col("o_custkey").alias("unit"), F.month("o_orderdate").alias("period")).agg(
        F.avg("o_totalprice").alias("y"), F.count(F.lit(1)).cast("double").alias("x")
    )
    activity = events.groupBy(F.col("user_id").alias("unit"), F.month("ts").alias("period")).agg(F.avg("value").alias("used"))
    return {"demand": demand, "activity": activity}


@query("outer_panel", f"""
WITH dm AS (SELECT o_custkey AS unit, CAST(month(o_orderdate) AS INTEGER) AS period, avg(o_totalprice) AS y, count(*)::DOUBLE AS x FROM orders GROUP BY 1, 2),
ac AS (SELECT user_id AS unit, CAST(month(ts) AS INTEGER) AS period, avg(value) AS used FROM events GROUP BY 1, 2)
SELECT unit, period, {q6('ln(y)')} AS log_y, {q6('x * x')} AS x_squared, {q6('ln(used)')} AS log_used FROM dm FULL JOIN ac USING (unit, period)""")
def outer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.outer_panel(outer_sources(spark, sf_dir), ["unit", "period"])
    # Means of amounts in cents often end in a 5 exactly; logs and squares do not, so rounding cannot tie.
    return wide.select(
        "unit", "period", r6(F.ln("y")).alias("log_y"), r6(F.col("x") * F.col("x")).alias("x_squared"),
        r6(F.ln("used")).alias("log_used"),
    )


# ---- readers, gates and sinks as whole round trips -----------------------------------------------------------------

def landed_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@query("delimited_read", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_name AS name, c_acctbal AS balance, c_nationkey AS nation FROM customer""")
def delimited_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with another delimiter, codes with leading zeros and typed columns."""
    folder = landed_folder(spark, "delimited")
    customer = table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias(" code "), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"),
    )
    customer.write.option("header", True).option("sep", ";").csv(folder)
    return landed.read_delimited(spark, folder, types={"balance": "double", "nation": "int"})


@query("folder_report", """
SELECT 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS header, 'segment_code' AS absent, count(*) AS n_rows, 0::BIGINT AS n_corrupt FROM customer
UNION ALL SELECT 's_suppkey,s_name,s_nationkey,s_acctbal', 'segment, segment_code', count(*), 0 FROM supplier""")
def folder_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = landed_folder(spark, "landed")
    for name in ("customer", "supplier"):
        table(spark, sf_dir, name).write.mode("append").option("header", True).csv(folder)
    return landed.folder_report(spark, folder, PARTY_ALIASES | {"segment_code": ["zone"]}).select(
        "header", F.array_join("absent", ", ").alias("absent"), "n_rows", "n_corrupt"
    )


@query("optional_rule", """
SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name FROM part WHERE contains(p_name, 'ring')""")
def optional_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without the optional column keep their rows: the rule on it is skipped."""
    folder = landed_folder(spark, "landed")
    table(spark, sf_dir, "part").select("p_partkey", "p_name").write.option("header", True).csv(folder)
    rows = landed.read_folder(spark, folder, "part", {"code": ["p_partkey"], "name": ["p_name"], "age": ["age_name"]})
    rules = {"name": ["ring"], "age": ["standard"]}
    return panel.keyword_filter(rows, rules, optional=["age"]).select("code", "name")


@query("contract_select", "SELECT n_name AS unit, n_nationkey AS code FROM nation")
def contract_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.select_contract(table(spark, sf_dir, "nation"), {"unit": "n_name", "code": "n_nationkey"})


@query("sorted_sink", """
SELECT l_suppkey, l_linenumber, n_lines, row_number() OVER (ORDER BY l_suppkey, l_linenumber) AS position
FROM (SELECT l_suppkey, l_linenumber, count(*) AS n_lines FROM lineitem GROUP BY 1, 2)""")
def sorted_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in key order as delimited text; the position is where its line stands in the files."""
    folder = landed_folder(spark, "sink")
    counted = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_lines"))
    write_table(counted, folder, ["l_suppkey", "l_linenumber"])
    lines = spark.read.schema("l_suppkey long, l_linenumber int, n_lines long").option("header", True).csv(folder)
    placed = lines.withColumns({"file": F.col("_metadata.file_name"), "at": F.monotonically_increasing_id()})
    return running_count(placed, ["file", "at"], "position").select("l_suppkey", "l_linenumber", "n_lines", "position")


@query("stage_copies", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def stage_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage partitioned by a column: one value's rows come from its files alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    stage = write_stage(orders, landed_folder(spark, "stage"), ["o_orderpriority"])
    return stage.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderpriority")


@query("schema_tools", """
SELECT p_partkey AS part_p_partkey, p_size AS part_p_size, p_retailprice AS part_p_retailprice FROM part WHERE p_partkey IS NOT NULL""")
def schema_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose and required columns, prefixes, and the numeric and available ones of a table."""
    part = schema.require_columns(table(spark, sf_dir, "part"), ["p_partkey", "p_size"], "part")
    key = schema.find_loose(part.columns, ("part key", "P_PARTKEY"))
    hinted = schema.find_by_hints(part.columns, ["retail", "price"])
    prefixed = schema.prefix_columns(part, "part_", [])
    wanted = [f"part_{c}" for c in (key, "p_size", hinted, "absent")]
    numeric = [c for c in schema.numeric_columns(prefixed) if c in schema.columns_with_prefix(prefixed, "part_")]
    return quality.assert_not_empty(prefixed.select(*[c for c in schema.available(prefixed, wanted) if c in numeric]), "part")


@query("same_label", """
SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_7'""")
def same_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality of normalised labels."""
    nation = table(spark, sf_dir, "nation").withColumn("label", F.concat(F.lit("  "), F.translate(F.lower("n_name"), "ai", "áî"), F.lit(" ")))
    chosen = nation.filter(name_key(F.col("label")) == name_key(F.lit("Nation_7 ")))
    return table(spark, sf_dir, "supplier").join(chosen, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("s_suppkey")


@query("resolved_only", f"WITH {CASCADE} SELECT c_custkey, resolved FROM rr WHERE resolved IS NOT NULL")
def resolved_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lenient policy keeps what was resolved; the strict one must refuse the same rows."""
    resolved = cascade(spark, sf_dir)
    try:
        lookup.keep_resolved(resolved, ["fonte", "label"], "fail")
    except quality.QualityError:
        return lookup.keep_resolved(resolved, ["fonte", "label"]).select("c_custkey", "resolved")
    raise AssertionError("unresolved labels passed the strict policy")


@query("source_class", """
SELECT c_mktsegment AS segment, TRUE AS single, FALSE AS mixed FROM customer GROUP BY 1""")
def source_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rows of one segment, and those of all, come from that segment alone."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("fonte"))
    whole = lookup.single_sources(customer, []).first()["source"]
    each = lookup.single_sources(customer.select("fonte", F.col("fonte").alias("segment")).dropna(), ["segment"])
    named = F.lower("segment")
    return each.select(
        "segment", F.coalesce(F.col("source") == named, F.lit(False)).alias("single"),
        F.coalesce(F.lit(whole) == named, F.lit(False)).alias("mixed"),
    )


@query("dup_examples", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 10""")
def dup_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten duplicate keys, as the failing gate lists them."""
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).orderBy(
        "l_orderkey", "l_linenumber"
    ).limit(10)
