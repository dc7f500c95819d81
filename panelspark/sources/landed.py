"""Readers of landed files: JSON payloads, delimited text, folders of mixed layouts."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.vocab import NULL_TOKENS
from panelspark.operators.schema import alias_project, missing_targets, quoted
from panelspark.session import settings

RECORD_SCHEMA = (
    "array<struct<countryiso3code: string, country: struct<value: string>, date: string, value: double>>"
)
#: Column for what stands beyond the last field of a header.
BEYOND = "_beyond"
#: Column that holds a whole record which is longer or shorter than the header.
ODD = "_odd"


def flatten_payload(df: DataFrame, payload: str, indicator: Column) -> DataFrame:
    """``[meta, [records]]`` texts -> one long row per record; a payload without records gives no rows."""
    records = F.from_json(F.try_element_at(F.from_json(F.col(payload), "array<string>"), F.lit(2)), RECORD_SCHEMA)
    rows = df.select(indicator.alias("indicador"), F.explode(records).alias("r"))
    return rows.select(
        F.col("r.countryiso3code").alias("iso3"),
        F.col("r.country.value").alias("pais"),
        F.col("r.date").try_cast("int").alias("ano"),
        "indicador",
        F.col("r.value").alias("valor"),
    )


def _payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole files below ``indicator=<code>`` directories with the code as text, just as the path has it."""
    files = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    code = F.regexp_extract(F.col("_metadata.file_path"), "/indicator=([^/]+)/[^/]*$", 1)
    plain = code
    for _ in range(2):  # the path is escaped as a URI, the name in it as a directory of a partition
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return files.select("value", plain.alias("indicator")).filter("indicator <> ''")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Landed payload files below ``folder``; the ``indicator=<code>`` directory of each is its tag.

    A file that is no payload adds no rows, so one failed indicator does not stop the others.
    """
    return flatten_payload(_payload_files(spark, folder), "value", F.col("indicator"))


def payload_report(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators whose landed files gave no record."""
    records = F.from_json(F.try_element_at(F.from_json("value", "array<string>"), F.lit(2)), RECORD_SCHEMA)
    counted = _payload_files(spark, folder).groupBy(F.col("indicator").alias("indicador")).agg(
        F.sum(F.coalesce(F.size(records), F.lit(0))).alias("n_records")
    )
    return counted.filter(F.coalesce("n_records", F.lit(0)) <= 0)


def nulls_from_tokens(df: DataFrame, tokens: Sequence[str] = tuple(NULL_TOKENS)) -> DataFrame:
    """Turn the texts that stand for "no value" into nulls in every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(quoted(c)).isin(list(tokens)), F.col(quoted(c))) for c in texts})


def header_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).head(1)
    return first[0]["value"].lstrip("﻿") if first else ""


def sniff_delimiter(header: str, candidates: str = ",;\t|") -> str:
    """Delimiter that splits the header into the most fields; comma on a tie."""
    return max(candidates, key=lambda d: (len(next(csv.reader([header], delimiter=d), [])), -candidates.index(d)))


def _split_header(header: str, delimiter: str) -> list[str]:
    """Header fields; empty names are numbered and repeated ones suffixed, so that a schema can be built."""
    names, seen = [], set()
    for i, name in enumerate(next(csv.reader([header], delimiter=delimiter), [])):
        base = name or f"Unnamed: {i}"
        unique, n = base, 0
        while unique.lower() in seen:
            n += 1
            unique = f"{base}.{n}"
        seen.add(unique.lower())
        names.append(unique)
    return names


def _read_raw(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], delimiter: str, multi_line: bool = False
) -> DataFrame:
    """Every field as text; BEYOND holds the first field too many of a record that is longer than the header."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BEYOND]])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    reader = reader.option("sep", delimiter).option("mode", "PERMISSIVE").option("escape", '"')
    reader = reader.option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", False)
    return reader.csv(list(paths))


def _read_strings(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], delimiter: str, multi_line: bool = False,
    ragged: str = "drop",
) -> DataFrame:
    if ragged not in ("drop", "fail"):
        raise ValueError("ragged is 'drop' or 'fail'")
    raw = _read_raw(spark, paths, names, delimiter, multi_line)
    whole = F.col(BEYOND).isNull()
    if ragged == "fail":
        record = F.concat_ws(delimiter, *map(quoted, [*names, BEYOND]))
        whole = F.when(~whole, F.raise_error(F.concat(F.lit("too many fields: "), record))).otherwise(F.lit(True))
    return nulls_from_tokens(raw.filter(whole).drop(BEYOND))


def read_delimited(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    delimiter: str | None = None,
    bad_header: str | None = None,
    strip_header: bool = True,
    multi_line: bool = False,
    ragged: str = "drop",
) -> DataFrame:
    """Delimited text with a header; every column is text unless ``types`` names another type (lenient cast).

    Codes such as ``004`` keep their zeros. ``bad_header`` names a header that proves the file corrupt. Records with
    more fields than the header are dropped, or (``ragged='fail'``) fail the query.
    """
    header = header_line(spark, path)
    sep = delimiter or sniff_delimiter(header)
    names = _split_header(header, sep)
    if strip_header:
        names = [n.strip() for n in names]
    if bad_header and bad_header in names:
        raise ValueError(f"{path}: corrupt header, a delimiter is missing in {bad_header!r}")
    df = _read_strings(spark, [path], names, sep, multi_line, ragged)
    for name, kind in (types or {}).items():
        if name in df.columns:
            df = df.withColumn(name, F.col(quoted(name)).try_cast(kind))
    return df


#: Headers that one job reads.
HEADERS_A_JOB = 100
#: A file is one split, whatever its length, so that a scan of its first line opens it once.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": 1 << 40, "spark.sql.files.openCostInBytes": 1 << 40}


def layouts(spark: SparkSession, folder: str, pattern: str = "*.csv") -> dict[str, list[str]]:
    """Header line -> paths of the files of one folder that have it; lock files (``~``) are left out.

    The files are listed, then HEADERS_A_JOB first lines a job are read by scans with a limit of one row, which stop
    after a buffer of each file, however long it is. What comes to the driver is a line for each file, as Spark's own
    listing does. Files that cannot be read, and those without a line, are left out.
    """
    reader = spark.read.option("ignoreCorruptFiles", True)
    try:
        listed = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return {}
        raise
    paths = sorted(p for p in map(unquote, listed) if not p.rsplit("/", 1)[1].startswith("~"))
    found: dict[str, list[str]] = {}
    for i in range(0, len(paths), HEADERS_A_JOB):
        part = paths[i:i + HEADERS_A_JOB]
        firsts = [reader.text(p).limit(1).select(F.lit(p).alias("path"), "value") for p in part]
        with settings(spark, _WHOLE_FILES):
            heads = dict(map(tuple, reduce(DataFrame.union, firsts).collect()))
        for path in part:
            if path in heads:
                found.setdefault(heads[path].lstrip("\ufeff"), []).append(path)
    return found


def read_folder(
    spark: SparkSession,
    folder: str,
    source: str,
    aliases: Mapping[str, Sequence[str]],
    pattern: str = "*.csv",
    delimiter: str = ",",
    multi_line: bool = False,
    ragged: str = "drop",
) -> DataFrame:
    """Every delimited file of a folder on one vocabulary.

    Files with the same header are read by one scan, and the scans are stacked by name. Targets that no file has are left
    out; those that some files have are null in the others. See :func:`folder_report` for what each layout lacks. An
    empty folder gives an empty table with all targets.
    """
    parts = [
        alias_project(_read_strings(spark, paths, _split_header(text, delimiter), delimiter, multi_line, ragged), aliases, source)
        for text, paths in layouts(spark, folder, pattern).items()
    ]
    if not parts:
        empty = T.StructType([T.StructField(n, T.StringType()) for n in [*aliases, "fonte"]])
        return spark.createDataFrame([], empty)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*[quoted(c) for c in [*aliases, "fonte"] if c in whole.columns])


REPORT = "header string, n_files bigint, absent array<string>, n_rows bigint, n_corrupt bigint, n_short bigint"


def folder_report(
    spark: SparkSession, folder: str, aliases: Mapping[str, Sequence[str]], pattern: str = "*.csv", delimiter: str = ","
) -> DataFrame:
    """For each layout of a folder: its files, the targets it lacks, its records, those with too many fields
    (``n_corrupt``: left out on reading), and those with too few or a quote that stays open (``n_short``: read as far as
    they go)."""
    parts = []
    for text, paths in layouts(spark, folder, pattern).items():
        names = _split_header(text, delimiter)
        absent = F.array(*map(F.lit, missing_targets(names, aliases))).cast("array<string>")
        layout = [F.lit(text).alias("header"), F.lit(len(paths)).cast("bigint").alias("n_files"), absent.alias("absent")]
        n, none = F.count(F.lit(1)), F.lit(0).cast("bigint")
        raw = _read_raw(spark, paths, names, delimiter)
        parts.append(raw.agg(*layout, n.alias("n_rows"), F.count(BEYOND).alias("n_corrupt"), none.alias("n_odd")))
        odd = _odd_records(spark, paths, names, delimiter)
        parts.append(odd.agg(*layout, none.alias("n_rows"), none.alias("n_corrupt"), n.alias("n_odd")))
    if not parts:
        return spark.createDataFrame([], REPORT)
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("header").agg(
        F.max("n_files").alias("n_files"), F.first("absent").alias("absent"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_corrupt").alias("n_corrupt"), (F.sum("n_odd") - F.sum("n_corrupt")).alias("n_short"),
    )


def _odd_records(spark: SparkSession, paths: Sequence[str], names: Sequence[str], delimiter: str) -> DataFrame:
    """The records that have more or fewer fields than the header, as they are written, by Spark's own capture."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, ODD]])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("sep", delimiter)
    reader = reader.option("mode", "PERMISSIVE").option("escape", '"').option("columnNameOfCorruptRecord", ODD)
    # all fields are parsed, or a record's length would not be seen; a scan must ask for one beside the capture
    read = reader.option("columnPruning", False).csv(list(paths))
    return read.filter(F.col(ODD).isNotNull() & (F.length(F.coalesce(F.col(quoted(names[0])), F.lit(""))) >= 0)).select(ODD)


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "nome_indicador") -> DataFrame:
    """Stack like tables by name, each tagged with its key."""
    if not parts:
        raise ValueError("union_tagged needs at least one table")
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def first_non_empty(candidates: Mapping[str, DataFrame], origin: str = "origem") -> DataFrame:
    """The first table with a row, tagged with its name; later ones are not read."""
    if not candidates:
        raise ValueError("first_non_empty needs at least one table")
    last = None
    for name, df in candidates.items():
        last = df.withColumn(origin, F.lit(name))
        if not df.isEmpty():
            return last
    return last


def select_contract(df: DataFrame, columns: Mapping[str, str]) -> DataFrame | None:
    """Rename a fixed layout (target -> source) onto its contract; None with a warning if a column is absent."""
    missing = sorted(set(columns.values()) - set(df.columns))
    if missing:
        warnings.warn(f"unexpected layout, columns {missing} are absent", stacklevel=2)
        return None
    return df.select(*[F.col(quoted(old)).alias(new) for new, old in columns.items()])
