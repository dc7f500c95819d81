"""Entity resolution: id, padded-code and alias look-ups, fuzzy fallback, cascade and audit trail.

The dimensions are plain joins without a broadcast hint: Spark broadcasts a side it has measured to be small and
otherwise sort-merges with AQE skew splitting, so neither a large dictionary nor a hot name breaks the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.numeric import to_int
from panelspark.functions.text import code_key, name_key, zero_fill
from panelspark.operators.quality import QualityError, guard
from panelspark.operators.schema import fresh_name, quoted, require_columns
from panelspark.session import materialise, release

CODE_PATTERN = "^[A-Z]{3}$"


def valid_code(c: Column, pattern: str = CODE_PATTERN) -> Column:
    """The trimmed upper-case code if it fits the pattern, else null."""
    code = code_key(c)
    return F.when(code.rlike(pattern), code)


def id_dimension(df: DataFrame, id_column: str, code_column: str, pattern: str = CODE_PATTERN) -> DataFrame:
    """Checked ``(dim_id, dim_code)``: unique integer ids, codes that fit the pattern."""
    require_columns(df, [id_column, code_column], "id dimension")
    typed = df.select(
        to_int(F.col(id_column)).alias("dim_id"), code_key(F.col(code_column)).alias("dim_code")
    ).dropna()
    checked = typed.groupBy("dim_id").agg(F.count(F.lit(1)).alias("n"), F.min("dim_code").alias("dim_code"))
    broken = (F.col("n") > 1) | ~F.col("dim_code").rlike(pattern)
    message = F.concat(F.lit("id dimension: duplicate id or bad code at "), F.col("dim_id").cast("string"))
    return checked.select("dim_id", guard(F.col("dim_code"), broken, message).alias("dim_code"))


def alias_dimension(spark: SparkSession, aliases: Mapping[str, str | None] | DataFrame) -> DataFrame:
    """``(alias_key, alias_code, alias_known)`` on the normalised name; a null code means "known, but no entity".

    When spellings that share a key disagree, the last one listed wins for a mapping and the smallest code for a table.
    """
    if isinstance(aliases, DataFrame):
        keyed = aliases.select(name_key(F.col("alias")).alias("alias_key"), F.col("code").alias("alias_code"))
        rank = F.struct(F.col("alias_code").isNull().alias("unset"), F.col("alias_code").alias("code"))
        best = keyed.groupBy("alias_key").agg(F.min(rank).alias("best"))
        return best.select("alias_key", F.col("best.code").alias("alias_code"), F.lit(True).alias("alias_known"))
    rows = [(i, name, code) for i, (name, code) in enumerate(aliases.items())]
    listed = spark.createDataFrame(rows, "pos int, alias string, code string")
    last = listed.groupBy(name_key(F.col("alias")).alias("alias_key")).agg(
        F.max(F.struct("pos", "code")).alias("last")
    )
    return last.select("alias_key", F.col("last.code").alias("alias_code"), F.lit(True).alias("alias_known"))


def id_lookup(df: DataFrame, column: str, dimension: DataFrame, out: str) -> DataFrame:
    """Numeric-looking text -> code through a checked :func:`id_dimension`."""
    keyed = df.withColumn("dim_id", to_int(F.col(column)))
    return keyed.join(dimension, "dim_id", "left").drop("dim_id").withColumnRenamed("dim_code", out)


def padded_code_lookup(
    df: DataFrame, column: str, dimension: DataFrame, out: str, width: int = 3
) -> DataFrame:
    """Code text with lost zeros or a trailing ``.0`` -> code, through a table ``(padded, code)``."""
    text = F.regexp_replace(F.trim(F.col(column).cast("string")), r"\.0$", "")
    dim = dimension.select(F.col(dimension.columns[0]).alias("_padded"), F.col(dimension.columns[1]).alias(out))
    return df.withColumn("_padded", zero_fill(text, width)).join(dim, "_padded", "left").drop("_padded")


def alias_lookup(df: DataFrame, column: str, aliases: DataFrame, out: str) -> DataFrame:
    """Name -> code through an :func:`alias_dimension`; ``<out>_known`` is true even where the code is null."""
    keyed = df.withColumn("alias_key", name_key(F.col(column)))
    joined = keyed.join(aliases, "alias_key", "left").drop("alias_key")
    return joined.withColumn(f"{out}_known", F.coalesce("alias_known", F.lit(False))).drop(
        "alias_known"
    ).withColumnRenamed("alias_code", out)


def _shorter_forms(key: Column, edits: int) -> Column:
    """The key and every text got from it by deleting up to ``edits`` characters."""
    forms = F.array(key)
    for _ in range(edits):
        cut = F.flatten(
            F.transform(
                forms,
                lambda s: F.when(
                    F.length(s) > 0,
                    F.transform(
                        F.sequence(F.lit(1), F.length(s)),
                        lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))),
                    ),
                ).otherwise(F.array(s)),
            )
        )
        forms = F.array_distinct(F.concat(forms, cut))
    return forms


def fuzzy_lookup(names: DataFrame, column: str, dictionary: DataFrame, max_edits: int = 1) -> DataFrame:
    """Best dictionary entry within ``max_edits`` Levenshtein edits of each distinct name.

    ``dictionary`` has ``(entry, code)``. Two texts within d edits share a form with at most d characters deleted
    from each, so an equi-join on those forms finds every partner without comparing all pairs. The winner has the
    fewest edits, then the smallest entry. Returns ``name_key, fuzzy_entry, fuzzy_code, fuzzy_edits, fuzzy_score``.
    """
    left = names.select(name_key(F.col(column)).alias("name_key")).filter("name_key <> ''").distinct()
    right = dictionary.select(name_key(F.col("entry")).alias("entry_key"), "entry", "code").filter("entry_key <> ''")
    left_forms = left.select("name_key", F.explode(_shorter_forms(F.col("name_key"), max_edits)).alias("form"))
    right_forms = right.select("*", F.explode(_shorter_forms(F.col("entry_key"), max_edits)).alias("form"))
    edits = F.levenshtein("name_key", "entry_key")
    scored = left_forms.join(right_forms, "form").withColumn("edits", edits).filter(F.col("edits") <= max_edits)
    best = scored.groupBy("name_key").agg(F.min(F.struct("edits", "entry", "code", "entry_key")).alias("best"))
    longest = F.greatest(F.length("name_key"), F.length(F.col("best.entry_key")))
    return best.select(
        "name_key",
        F.col("best.entry").alias("fuzzy_entry"),
        F.col("best.code").alias("fuzzy_code"),
        F.col("best.edits").alias("fuzzy_edits"),
        (F.lit(1.0) - F.col("best.edits") / longest).alias("fuzzy_score"),
    )


def _tokens(key: Column) -> Column:
    """The distinct words of a name key, without punctuation."""
    return F.array_distinct(F.filter(F.split(key, r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def _nearest_tokens(words: DataFrame, tokens: DataFrame, max_edits: int) -> DataFrame:
    """``(word, token, edits)``: the dictionary token with the fewest edits; words of under four letters must be equal."""
    w = words.select("word", F.explode(_shorter_forms(F.col("word"), max_edits)).alias("form"))
    t = tokens.select("token", F.explode(_shorter_forms(F.col("token"), max_edits)).alias("form"))
    edits = F.levenshtein("word", "token")
    allowed = F.when(F.least(F.length("word"), F.length("token")) >= 4, max_edits).otherwise(0)
    near = w.join(t, "form").withColumn("edits", edits).filter(F.col("edits") <= allowed)
    best = near.groupBy("word").agg(F.min(F.struct("edits", "token")).alias("best"))
    return best.select("word", "best.token", "best.edits")


def _weighed(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """A row for each key: its ``words`` (rarest first), their ``total`` weight, and the ``prefix`` of tokens without which
    the others weigh less than the threshold's share, so that a partner must have one of them."""
    word = F.struct((-F.col("weight")).alias("order"), "token", "weight", "quality")
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(word)).alias("words"))

    def weight(words: Column) -> Column:
        return F.aggregate(words, F.lit(0.0), lambda acc, w: acc + w["weight"])

    listed = listed.withColumn("total", weight(F.col("words")))
    from_here = F.transform("words", lambda w, i: F.struct(
        w["token"].alias("token"), weight(F.slice("words", i + 1, F.size("words"))).alias("rest")
    ))
    needed = F.filter(from_here, lambda w: w["rest"] >= F.lit(threshold) * F.col("total") - 1e-9)
    return listed.withColumn("prefix", needed["token"])


def token_lookup(
    names: DataFrame, column: str, dictionary: DataFrame, threshold: float = 0.7, max_edits: int = 1
) -> DataFrame:
    """Best dictionary entry by shared words, whatever their order: ``name_key, fuzzy_entry, fuzzy_code, fuzzy_score``.

    A word weighs ln(1 + entries / entries that hold it). A name's words first take the nearest dictionary words within
    ``max_edits`` (a share of the weight is lost for each edit); words that no entry holds weigh most. The score is the
    weight in common over the weight of the union; the best of at least ``threshold`` wins, then the smallest entry.

    Names and entries meet on an inverted index of their prefixes of rarest words (an equi-join): a pair that reaches the
    threshold has a word of both prefixes in common, so none is lost, and words that many entries hold make few pairs.
    """
    left = names.select(name_key(F.col(column)).alias("name_key")).filter("name_key <> ''").distinct()
    right = dictionary.select(name_key(F.col("entry")).alias("entry_key"), "entry", "code").filter("entry_key <> ''")
    n_entries = F.lit(float(max(1, right.count())))
    held = right.select("entry", "code", F.explode(_tokens(F.col("entry_key"))).alias("token"))
    weights = held.groupBy("token").agg(F.log1p(n_entries / F.count(F.lit(1))).alias("weight"))
    entries = _weighed(held.join(weights, "token").withColumn("quality", F.lit(1.0)), ["entry", "code"], threshold)

    spoken = left.select("name_key", F.explode(_tokens(F.col("name_key"))).alias("word"))
    nearest = _nearest_tokens(spoken.select("word").distinct(), weights.select("token"), max_edits).join(weights, "token")
    quality = F.lit(1.0) - F.col("edits") / F.greatest(F.length("word"), F.length("token"))
    known = spoken.join(nearest, "word", "left").groupBy("name_key", F.coalesce("token", "word").alias("token")).agg(
        F.max(F.coalesce("weight", F.log1p(n_entries))).alias("weight"), F.max(F.coalesce(quality, F.lit(0.0))).alias("quality")
    )
    spoken_for = _weighed(known, ["name_key"], threshold).select(
        "name_key", F.col("words").alias("mine"), F.col("total").alias("my_total"), F.explode("prefix").alias("token")
    )
    pairs = spoken_for.join(entries.select("*", F.explode("prefix").alias("token")), "token")
    common = F.filter("mine", lambda m: F.exists("words", lambda w: w["token"] == m["token"]))
    shared = F.aggregate(common, F.lit(0.0), lambda acc, m: acc + m["weight"])
    agreed = F.aggregate(common, F.lit(0.0), lambda acc, m: acc + m["weight"] * m["quality"])
    scored = pairs.withColumn("score", agreed / (F.col("my_total") + F.col("total") - shared))
    best = scored.filter(F.col("score") >= threshold).groupBy("name_key").agg(
        F.min(F.struct((-F.round("score", 12)).alias("worse"), "entry", "code", "score")).alias("best")
    )
    return best.select(
        "name_key", F.col("best.entry").alias("fuzzy_entry"), F.col("best.code").alias("fuzzy_code"),
        F.col("best.score").alias("fuzzy_score"),
    )


def resolve_cascade(
    df: DataFrame,
    code_column: str,
    name_column: str,
    aliases: DataFrame,
    id_dim: DataFrame | None = None,
    id_source: Column | None = None,
    dictionary: DataFrame | None = None,
    max_edits: int = 1,
    pattern: str = CODE_PATTERN,
    token_score: float | None = None,
) -> DataFrame:
    """Resolve each row: valid code, else id (for rows of an id source), else alias, else fuzzy name, else (where
    ``token_score`` is given) the dictionary entry whose words score at least that.

    Rows of an id source with a readable but unknown id stay unresolved; an alias that maps to null stops the search.
    Adds ``resolved`` and ``match_method`` (``code``, ``id``, ``alias``, ``fuzzy``, ``tokens``, ``unknown_id``,
    ``not_an_entity`` or ``none``).

    Only the distinct (code, name, id source) labels are resolved, written once and joined back: however many rows share
    a label, or have none, it is looked up once. Spark broadcasts that table where its measured size allows it and
    splits skewed labels otherwise.
    """
    from_id = F.lit(False) if id_source is None else F.coalesce(id_source, F.lit(False))
    flag = fresh_name("_from_id", df.columns)
    marked = df.withColumn(flag, from_id)
    label = [F.col(quoted(code_column)).alias("_raw"), F.col(quoted(name_column)).alias("_name"), F.col(flag).alias("_from_id")]
    labels = marked.select(*label).distinct()
    scratch: list[DataFrame] = []
    found = materialise(_resolve_labels(labels, aliases, id_dim, dictionary, max_edits, pattern, token_score, scratch))
    release(*scratch)
    same = (
        marked[code_column].eqNullSafe(found["_raw"]) & marked[name_column].eqNullSafe(found["_name"])
        & (marked[flag] == found["_from_id"])
    )
    return marked.join(found, same, "left").select(
        *[marked[quoted(c)] for c in df.columns], found["resolved"], found["match_method"]
    )


def _looked_up(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join in which rows whose key is null or blank stay out of the shuffle: they have no partner."""
    has_key = F.coalesce(F.col(key).cast("string") != "", F.lit(False))
    hits = df.filter(has_key).join(dimension, key, "left")
    return hits.unionByName(df.filter(~has_key), allowMissingColumns=True)


def _resolve_labels(labels, aliases, id_dim, dictionary, max_edits: int, pattern: str, token_score: float | None, scratch) -> DataFrame:
    work = materialise(labels.withColumns({
        "_code": valid_code(F.col("_raw"), pattern),
        "_id": F.when(F.col("_from_id"), to_int(F.col("_raw"))),
        "alias_key": name_key(F.col("_name")),
    }))
    scratch.append(work)
    if id_dim is None:
        work = work.withColumn("dim_code", F.lit(None).cast(T.StringType()))
    else:
        work = _looked_up(work, id_dim.withColumnRenamed("dim_id", "_id"), "_id")
    work = _looked_up(work, aliases, "alias_key")
    open_row = F.col("_code").isNull() & F.col("_id").isNull() & (F.col("alias_key") != "")
    no_alias = F.col("alias_known").isNull()
    if dictionary is None:
        work = work.withColumns({"fuzzy_code": F.lit(None).cast(T.StringType()), "fuzzy_how": F.lit(None).cast(T.StringType())})
    else:
        rest = work.filter(open_row & no_alias).select(F.col("alias_key").alias("_rest"))
        hits = fuzzy_lookup(rest, "_rest", dictionary, max_edits)
        hits = hits.select(F.col("name_key").alias("alias_key"), "fuzzy_code", F.lit("fuzzy").alias("fuzzy_how"))
        if token_score is not None:
            hits = materialise(hits)
            scratch.append(hits)
            left = rest.join(hits, F.col("_rest") == F.col("alias_key"), "left_anti")
            by_words = token_lookup(left, "_rest", dictionary, token_score, max_edits)
            hits = hits.union(by_words.select("name_key", "fuzzy_code", F.lit("tokens")))
        work = _looked_up(work, hits, "alias_key")
    by_name = F.col("_code").isNull() & F.col("_id").isNull()
    method = (
        F.when(F.col("_code").isNotNull(), "code")
        .when(F.col("_id").isNotNull() & F.col("dim_code").isNotNull(), "id")
        .when(F.col("_id").isNotNull(), "unknown_id")
        .when(by_name & F.col("alias_code").isNotNull() & (F.col("alias_key") != ""), "alias")
        .when(by_name & ~no_alias & (F.col("alias_key") != ""), "not_an_entity")
        .when(open_row & F.col("fuzzy_code").isNotNull(), F.col("fuzzy_how"))
        .otherwise("none")
    )
    marked = work.withColumn("match_method", method)
    picked = (
        F.when(F.col("match_method") == "code", F.col("_code"))
        .when(F.col("match_method") == "id", F.col("dim_code"))
        .when(F.col("match_method") == "alias", F.col("alias_code"))
        .when(F.col("match_method").isin("fuzzy", "tokens"), F.col("fuzzy_code"))
    )
    return marked.select("_raw", "_name", "_from_id", picked.alias("resolved"), "match_method")


def unresolved_report(resolved: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct unresolved labels with the number of rows behind each."""
    return resolved.filter(F.col("resolved").isNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


def keep_resolved(resolved: DataFrame, columns: list[str], on_unresolved: str = "drop", examples: int = 10) -> DataFrame:
    """Drop unresolved rows, or (``'fail'``) abort with examples before anything is written."""
    if on_unresolved not in ("drop", "fail"):
        raise ValueError("on_unresolved is 'drop' or 'fail'")
    if on_unresolved == "fail":
        found = unresolved_report(resolved, columns).orderBy(*columns).limit(examples).collect()
        if found:
            rows = "; ".join(", ".join(f"{c}={r[c]}" for c in columns) for r in found)
            raise QualityError(f"unresolved labels: {rows}")
    return resolved.filter(F.col("resolved").isNotNull())


def is_single_source(df: DataFrame, source: str, column: str = "fonte", file_name: str = "") -> bool:
    """Whether the file is named ``<source>_...`` or every non-null tag in ``column`` is ``source``, in either case."""
    if file_name.lower().startswith(f"{source.lower()}_"):
        return True
    if column not in df.columns:
        return False
    return single_sources(df, [], column).first()["source"] == source.lower()


def single_sources(df: DataFrame, by: Sequence[str], column: str = "fonte") -> DataFrame:
    """For each group (or for all rows) the one source that its non-null tags name, in lower case; null where they name
    several, or none."""
    tag = F.lower(quoted(column))
    seen = df.groupBy(*map(quoted, by)).agg(F.min(tag).alias("_low"), F.max(tag).alias("_high"))
    return seen.select(*map(quoted, by), F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("source"))
