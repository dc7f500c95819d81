import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.functions.vocab import COLUMN_ALIASES
from panelspark.sources import landed, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_payloads_skip_empty_and_broken_answers(spark, tmp_path):
    record = {"countryiso3code": "BRA", "country": {"value": "Brasil"}, "date": "2019", "value": 1.5}
    blank = {"countryiso3code": "", "country": {"value": "World"}, "date": None, "value": None}
    write(tmp_path / "indicator=A.1" / "a.json", json.dumps([{"page": 1}, [record, blank]], indent=1))
    write(tmp_path / "indicator=B" / "b.json", json.dumps([{"message": "no data"}]))
    write(tmp_path / "indicator=C" / "c.json", json.dumps([{"page": 1}, None]))
    write(tmp_path / "indicator=D" / "d.json", "<html>error</html>")
    rows = landed.read_payloads(spark, str(tmp_path)).orderBy("iso3").collect()
    assert [tuple(r) for r in rows] == [("", "World", None, "A.1", None), ("BRA", "Brasil", 2019, "A.1", 1.5)]
    assert sorted(r[0] for r in landed.payload_report(spark, str(tmp_path)).collect()) == ["B", "C", "D"]


def test_folder_on_one_vocabulary(spark, tmp_path):
    write(tmp_path / "a.csv", 'location_id,location_name,year,val\n006,"Korea, Rep.",2010,1.5\n,NA,2011,-\n')
    write(tmp_path / "b.csv", "location_id,location_name,year,val\n7,Brasil,2012,2\n")
    write(tmp_path / "c.csv", "Code,Country,Year,Value,Sex\nKEN,Kenya,2013,3,Both\n")
    write(tmp_path / "~lock.csv", "junk\n")
    df = landed.read_folder(spark, str(tmp_path), "gbd", COLUMN_ALIASES)
    assert df.columns == ["iso3", "pais", "ano", "sexo", "valor", "fonte"]  # targets that some file has
    report = {r["header"]: r for r in landed.folder_report(spark, str(tmp_path), COLUMN_ALIASES).collect()}
    assert sorted((r["n_files"], r["n_rows"], r["n_corrupt"]) for r in report.values()) == [(1, 1, 0), (2, 3, 0)]
    assert "sexo" in report["location_id,location_name,year,val"]["absent"]
    rows = {r["ano"]: r for r in df.collect()}
    assert rows["2010"]["iso3"] == "006" and rows["2010"]["pais"] == "Korea, Rep."
    assert rows["2011"]["iso3"] is None and rows["2011"]["pais"] is None and rows["2011"]["valor"] == "-"
    assert rows["2013"]["sexo"] == "Both" and rows["2012"]["sexo"] is None
    assert len(rows) == 4 and {r["fonte"] for r in rows.values()} == {"gbd"}


def test_headers_cost_a_buffer_of_each_file(spark, tmp_path, monkeypatch):
    line = "2010," + "9" * 93 + "\n"
    for name, header in (("a", "year,val"), ("b", "year,val"), ("c", "ano,val"), ("~d", "junk")):
        write(tmp_path / f"{name}.csv", header + "\n" + line * 150_000)
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "mark 1.csv", "\ufeffyear,val\n2011,1\n")
    known = spark._jvm.org.apache.hadoop.fs.FileSystem

    def bytes_read():
        return sum(s.getBytesRead() for s in known.getAllStatistics())

    before, kept = bytes_read(), spark.conf.get("spark.sql.files.openCostInBytes")
    found = landed.layouts(spark, str(tmp_path))
    assert bytes_read() - before < 4 << 20  # of 60 MB
    assert {h: [p.rsplit("/", 1)[1] for p in paths] for h, paths in found.items()} == {
        "year,val": ["a.csv", "b.csv", "mark 1.csv"], "ano,val": ["c.csv"]
    }
    assert spark.conf.get("spark.sql.files.openCostInBytes") == kept
    monkeypatch.setattr(landed, "HEADERS_A_JOB", 2)
    assert landed.layouts(spark, str(tmp_path)) == found
    rows = landed.read_folder(spark, str(tmp_path), "s", {"ano": ["year", "ano"], "valor": ["val"]})
    assert rows.count() == 450_001 and rows.filter("ano = '2011'").count() == 1


def test_tags_are_text(spark, tmp_path):
    body = json.dumps([{"page": 1}, [{"countryiso3code": "BRA", "country": {"value": "B"}, "date": "2019", "value": 1}]])
    for tag in ("0012", "1.10", "a%2Fb", "x+y"):
        write(tmp_path / f"indicator={tag}" / "p.json", body)
    assert sorted(r["indicador"] for r in landed.read_payloads(spark, str(tmp_path)).collect()) == ["0012", "1.10", "a/b", "x+y"]


def test_records_with_too_many_fields(spark, tmp_path):
    write(tmp_path / "a.csv", 'year,val\n2010,1\n2011,2,3\n2012\n2013,"4,5"\n')
    aliases = {"ano": ["year"], "valor": ["val"]}
    rows = landed.read_folder(spark, str(tmp_path), "s", aliases).orderBy("ano").collect()
    assert [(r["ano"], r["valor"]) for r in rows] == [("2010", "1"), ("2012", None), ("2013", "4,5")]
    report = landed.folder_report(spark, str(tmp_path), aliases).first()
    assert (report["n_rows"], report["n_corrupt"], report["absent"]) == (4, 1, [])
    with pytest.raises(PySparkException, match="too many fields"):
        landed.read_folder(spark, str(tmp_path), "s", aliases, ragged="fail").collect()
    assert landed.read_delimited(spark, str(tmp_path / "a.csv")).count() == 3


def test_empty_folder_keeps_the_schema(spark, tmp_path):
    assert landed.folder_report(spark, str(tmp_path), {"a": ["A"]}).isEmpty()
    df = landed.read_folder(spark, str(tmp_path), "x", {"a": ["A"]})
    assert df.columns == ["a", "fonte"] and df.isEmpty()


def test_any_delimiter_and_the_corrupt_header(spark, tmp_path):
    write(tmp_path / "t.csv", " iso3 ; x2-proporcao ;n\nBRA;0,5;4\n")
    df = landed.read_delimited(spark, str(tmp_path / "t.csv"), types={"n": "int"})
    assert df.columns == ["iso3", "x2-proporcao", "n"] and df.first()["n"] == 4
    write(tmp_path / "u.csv", "iso3,abfused\nBRA,1\n")
    with pytest.raises(ValueError, match="corrupt header"):
        landed.read_delimited(spark, str(tmp_path / "u.csv"), bad_header="abfused")


def test_source_preference_and_contract(spark):
    empty, full = spark.range(0).toDF("a"), spark.range(2).toDF("a")
    assert landed.first_non_empty({"manual": empty, "api": full}).select("origem").distinct().first()[0] == "api"
    assert landed.first_non_empty({"manual": empty, "api": empty}).isEmpty()
    with pytest.warns(UserWarning):
        assert landed.select_contract(full, {"x": "absent"}) is None
    assert landed.select_contract(full, {"x": "a"}).columns == ["x"]


def test_sinks(spark, tmp_path):
    df = spark.range(4).select((F.col("id") % 2).alias("imp"), F.col("id").alias("v"))
    back = sinks.write_stage(df, str(tmp_path / "stage"), ["imp"])
    assert back.filter("imp = 1").count() == 2
    assert "PartitionFilters: [isnotnull(imp" in back.filter("imp = 1")._jdf.queryExecution().executedPlan().toString()
    sinks.write_table(df, str(tmp_path / "table"), ["v"])
    assert spark.read.option("header", True).csv(str(tmp_path / "table")).count() == 4


def test_report_counts_short_records_and_open_quotes(spark, tmp_path):
    good = "".join(f"{i:03d},Name {i},20{i:02d},{i}.5\n" for i in range(10, 30))
    write(tmp_path / "a.csv", "location_id,location_name,year,val\n" + good + "7,Brasil\n8,\"Chile,2012,2\n9,Peru,2012,2,extra\n")
    write(tmp_path / "b.csv", "Code,Country\nKEN,Kenya\n")
    report = {r["header"]: r for r in landed.folder_report(spark, str(tmp_path), COLUMN_ALIASES).collect()}
    told = report["location_id,location_name,year,val"]
    assert (told["n_rows"], told["n_corrupt"], told["n_short"]) == (23, 1, 2)
    assert (report["Code,Country"]["n_rows"], report["Code,Country"]["n_short"]) == (1, 0)
    rows = {r["iso3"]: r for r in landed.read_folder(spark, str(tmp_path), "gbd", COLUMN_ALIASES).collect()}
    assert rows["7"]["pais"] == "Brasil" and rows["7"]["ano"] is None and "9" not in rows


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    stage, text = str(tmp_path / "stage"), str(tmp_path / "text")
    rows = spark.range(20).withColumn("part", F.col("id") % 2)
    for path, write_it in ((stage, lambda df: sinks.write_stage(df, path, ["part"])), (text, lambda df: sinks.write_table(df, path))):
        write_it(rows)
        broken = spark.range(100).repartition(4).select(
            F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"), (F.col("id") % 3).alias("part")
        )
        with pytest.raises(PySparkException, match="lost"):
            write_it(broken)
        read = spark.read.parquet(path) if path == stage else spark.read.option("header", True).csv(path)
        assert read.count() == 20
        write_it(rows.limit(5))
        read = spark.read.parquet(path) if path == stage else spark.read.option("header", True).csv(path)
        assert read.count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["stage", "text"]


def test_a_stage_may_replace_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "stage")
    sinks.write_stage(spark.range(10).toDF("x"), path)
    again = sinks.write_stage(spark.read.parquet(path).select(F.col("x") + 1), path)
    assert sorted(r[0] for r in again.collect()) == list(range(1, 11))


def test_an_undone_rename_keeps_the_old_table():
    moves = []

    def rename(a, b):
        moves.append((a, b))
        return a != "new"

    with pytest.raises(OSError):
        sinks._renamed(rename, "new", "table", "old")
    assert moves == [("table", "old"), ("new", "table"), ("old", "table")]
