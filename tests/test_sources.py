"""Source edge cases the fixture does not reach."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from headway.operators.static import parse_stop_list
from headway.sources import files


def test_parse_stop_list_literal(spark):
    df = spark.createDataFrame([("['20921', '21010']",), ("[]",), ('["7"]',)], "s string")
    got = [r[0] for r in df.select(parse_stop_list("s")).collect()]
    assert got == [["20921", "21010"], [], ["7"]]


def test_eta_json_reference_document_and_empty_route(spark):
    d = tempfile.mkdtemp(prefix="eta-")
    # the reference writes one JSON document on one line; a route may map to {}
    with open(os.path.join(d, "output.json"), "w") as fh:
        json.dump({"2726": {"21269": "2025-08-19 08:50:38"}, "1861": {}}, fh)
    rows = sorted(tuple(r) for r in files.read_eta_json(spark, d).collect())
    assert rows == [("1861", None, None), ("2726", "21269", "2025-08-19 08:50:38")]


def _folder(**contents):
    d = tempfile.mkdtemp(prefix="eta-")
    for name, text in contents.items():
        with open(os.path.join(d, name + ".json"), "w") as fh:
            fh.write(text)
    return d


def test_eta_json_layouts_are_told_apart_by_file(spark):
    two_lines = '{"1": {"a": "2025-01-01 00:00:01"}}\n\n{"2": {"b": "2025-01-01 00:00:02", "c": "2025-01-01 00:00:03"}}\n'
    pretty = json.dumps({"3": {"d": "2025-01-01 00:00:04"}, "4": {}}, indent=2)
    long = json.dumps({str(k): {"x": "2025-01-01 00:00:05"} for k in range(1000, 1300)}, indent=1)
    rows = sorted(tuple(r) for r in files.read_eta_json(spark, _folder(a=two_lines, b=pretty, c=long, d="", e="\n \n")).collect() if r[0] < "1000" or r[0] > "1299")
    assert rows == [("1", "a", "2025-01-01 00:00:01"), ("2", "b", "2025-01-01 00:00:02"), ("2", "c", "2025-01-01 00:00:03"),
                    ("3", "d", "2025-01-01 00:00:04"), ("4", None, None)]
    assert files.read_eta_json(spark, _folder(c=long)).count() == 300


@pytest.mark.parametrize("text", ['{"1": {}} {"2": {}}', '{"1": {}}, {"2": {}}', '{"1": {}} x', 'x', '{\n"1": {}\n}\n{\n"2": {}\n}', '{"1": {}}\n{\n"2": {}\n}'])
def test_eta_json_text_after_a_document_raises(spark, text):
    with pytest.raises(Exception, match="not one JSON document"):
        files.read_eta_json(spark, _folder(a=text, b='{"9": {}}')).collect()


def _features(spark, rows):
    return spark.createDataFrame(rows, "date string, route_id string, trip_id string, latitude double, longitude double, x double").withColumn("date", F.to_date("date"))


def test_features_are_clustered_by_route(spark, tmp_path):
    root = str(tmp_path / "feats")
    rows = [(f"2024-01-0{d}", f"{r:03d}", f"t{k}", 1.0, 2.0, float(k)) for d in (1, 2) for r in range(40) for k in range(50)]
    files.write_route_features(_features(spark, rows), root, file_bytes=4096)
    names = [f for d in os.listdir(root) if d.startswith("date=") for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")]
    size = files.stored_bytes(spark.read.parquet(root))
    assert sorted(d for d in os.listdir(root) if d.startswith("date=")) == ["date=2024-01-01", "date=2024-01-02"]
    assert 4 < len(names) <= -(-size // 4096) + 2 + 8       # about a file per 4 kB, and no more than one more per date
    one = files.read_route_features(spark, root).where("route_id = '007' and date = '2024-01-02'")
    assert one.count() == 50 and {r["geometry"] for r in one.collect()} == {"POINT (2 1)"}
    plan = one._jdf.queryExecution().toString()
    assert "EqualTo(route_id,007)" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert one.select(F.col("_metadata.file_path")).distinct().count() <= 2


def test_features_of_a_route_are_replaced(spark, tmp_path):
    root = str(tmp_path / "feats")
    files.write_route_features(_features(spark, [("2024-01-01", "a", "t", 1.0, 2.0, 1.0), ("2024-01-01", "b", "t", 1.0, 2.0, 1.0), ("2024-01-02", "a", "t", 1.0, 2.0, 1.0)]), root)
    files.write_route_features(_features(spark, [("2024-01-01", "a", "u", 1.0, 2.0, 5.0), ("2024-01-03", "c", "u", 1.0, 2.0, 6.0)]), root)
    got = sorted((str(r["date"]), r["route_id"], r["x"]) for r in files.read_route_features(spark, root).collect())
    assert got == [("2024-01-01", "a", 5.0), ("2024-01-01", "b", 1.0), ("2024-01-02", "a", 1.0), ("2024-01-03", "c", 6.0)]


def test_features_whose_files_disagree(spark, tmp_path):
    root = str(tmp_path / "feats")
    for day, kind, extra in (("2024-01-01", "int", {}), ("2024-01-02", "double", {}), ("2024-01-03", "string", {"y": F.lit(1)}), ("2024-01-04", "int", {"y": F.lit(2.5)})):
        spark.range(3).select(F.lit("7").alias("route_id"), F.when(F.col("id") > 0, F.col("id")).cast(kind).alias("x"), F.lit(day).alias("date")).withColumns(extra) \
            .coalesce(1).write.mode("append").partitionBy("date").parquet(root)
    got = files.read_route_features(spark, root)
    assert dict(got.dtypes)["x"] == "string" and dict(got.dtypes)["y"] == "double"
    rows = sorted((str(r["date"]), r["x"] or "", r["y"]) for r in got.collect())
    assert rows == [("2024-01-01", "", None), ("2024-01-01", "1", None), ("2024-01-01", "2", None), ("2024-01-02", "", None), ("2024-01-02", "1.0", None), ("2024-01-02", "2.0", None),
                    ("2024-01-03", "", 1.0), ("2024-01-03", "1", 1.0), ("2024-01-03", "2", 1.0), ("2024-01-04", "", 2.5), ("2024-01-04", "1", 2.5), ("2024-01-04", "2", 2.5)]
    changed = sorted(map(tuple, files.coerced_values(spark, root).collect()))
    assert changed == [("x", "double", "string", 1, 2), ("x", "int", "string", 2, 4), ("y", "int", "double", 1, 3)]


def test_common_types():
    cases = {("int",): "int", ("int", "bigint"): "bigint", ("int", "double"): "double", ("bigint", "float"): "double", ("smallint", "float"): "float",
             ("int", "string"): "string", ("date", "timestamp"): "timestamp", ("date", "timestamp_ntz"): "timestamp_ntz", ("boolean", "int"): "string", ("array<int>", "int"): "string"}
    assert {k: files.common_type(set(k)) for k in cases} == cases


def _pings_folder(spark, root):
    for day, n in (("2024-01-01", 3), ("2024-01-02", 0), ("2024-01-03", 2)):
        spark.range(n).coalesce(1).write.parquet(f"{root}/date={day}")
    good = next(f for f in os.listdir(f"{root}/date=2024-01-01") if f.endswith(".parquet"))
    whole = open(f"{root}/date=2024-01-01/{good}", "rb").read()
    for name, body in (("date=2024-01-03/cut.parquet", whole[:-20]), ("date=2024-01-03/junk.parquet", b"PAR1 nothing"),
                       ("date=2024-01-03/torn.parquet", whole[:4] + bytes(len(whole[4:40])) + whole[40:])):
        open(f"{root}/{name}", "wb").write(body)


def test_files_are_told_apart(spark, tmp_path):
    root = str(tmp_path / "pings")
    _pings_folder(spark, root)
    got = {os.path.basename(r["path"]) if "part-" not in r["path"] else r["path"].split("/")[-2]: (r["rows"], r["status"]) for r in files.file_status(spark, root).collect()}
    assert got == {"date=2024-01-01": (3, "ok"), "date=2024-01-02": (0, "empty"), "date=2024-01-03": (2, "ok"), "cut.parquet": (0, "unreadable"), "junk.parquet": (0, "unreadable"),
                   "torn.parquet": (0, "damaged")}
    audit = {r["date"]: tuple(r)[1:] for r in files.audit_pings(spark, root, ["2024-01-01", "date=2024-01-02", "2024-01-03", "2024-01-09"]).collect()}
    assert audit == {"2024-01-01": (1, 1, 0, 0, 0, 3, "ok"), "2024-01-02": (1, 0, 1, 0, 0, 0, "ok"), "2024-01-03": (4, 1, 0, 2, 1, 2, "partial"), "2024-01-09": (0, 0, 0, 0, 0, 0, "missing")}
    assert len(files.read_pings(spark, root, skip_unreadable=True).collect()) == 5      # a count alone reads footers only


def test_one_bad_query_does_not_stop_the_others(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "q" / "good"))
    spark.createDataFrame([(9,)], "id int").coalesce(1).write.parquet(str(tmp_path / "q" / "other"))       # another type
    (tmp_path / "q" / "bad.parquet").write_bytes(b"PAR1 nothing")
    single = next(str(f) for f in (tmp_path / "q" / "other").iterdir() if f.name.endswith(".parquet"))
    entries = {"0": str(tmp_path / "q" / "good"), "1": str(tmp_path / "q" / "bad.parquet"), "2": "file://" + single, "3": str(tmp_path / "q" / "gone.parquet"), "4": str(tmp_path / "q" / "good") + "/"}
    (tmp_path / "manifest.json").write_text(json.dumps(entries))
    got = files.read_query_manifest(spark, str(tmp_path / "manifest.json"))
    assert sorted((r["query_id"], r["manifest_pos"], r["id"]) for r in got.collect()) == [("0", 0, 0), ("0", 0, 1), ("0", 0, 2), ("0", 0, 3), ("2", 2, 9), ("4", 4, 0), ("4", 4, 1), ("4", 4, 2), ("4", 4, 3)]
    status = [(r["query_id"], r["files"], r["rows"], r["status"]) for r in files.query_status(spark, str(tmp_path / "manifest.json")).orderBy("manifest_pos").collect()]
    assert status == [("0", 1, 4, "ok"), ("1", 1, 0, "unreadable"), ("2", 1, 1, "ok"), ("3", 0, 0, "missing"), ("4", 1, 4, "ok")]


def test_pings_by_day_shuffle_the_orders_only(spark):
    """Stored pings are dealt by day before they are made of their orders."""
    from headway.sources import fixtures
    plan = fixtures.raw_pings(spark, "/root/testdata/sf0.001", by_day=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")   # printed from the result downwards
    assert plan.count("RepartitionByExpression") == 1 and "RebalancePartitions" not in plan


def test_stream_source_is_written_where_its_rows_are(spark, tmp_path):
    from headway.streaming.stream import write_stream_source
    src = write_stream_source(spark.range(0, 700, 1, 7), str(tmp_path / "src"))
    assert len(list((tmp_path / "src").glob("*.parquet"))) == 7
    assert spark.read.parquet(src).count() == 700
