"""Intake: quotes, blanks, byte order marks, ids of digits, torn lines, spellings of flags."""

import pytest

from gnomon.sources import readers, writers


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_label_export(spark, tmp_path):
    columns = [*readers.TEXT, *readers.WHOLE, *readers.REAL]
    row = dict.fromkeys(columns, "") | {"label_id": "7", "pano_id": "00123", "tags": '"[a,b c]"', "time_created": "1609459200000", "heading": "1.5", "pitch": "NaN"}
    path = put(tmp_path / "oradell-nj.csv", "﻿" + ",".join(columns) + ",more\r\n" + ",".join(row[k] for k in columns) + ',"x\ny"\r\n')
    got = readers.label_export(spark, path).first()
    assert (got["city"], got["label_id"], got["pano_id"], got["tags"], got["heading"], got["pitch"], got["pano_x"], got["era"], got["pano_source"]) == ("oradell-nj", 7, "00123", "[a,b c]", 1.5, None, None, "mid", None)
    with pytest.raises(ValueError, match="missing columns"):
        readers.label_export(spark, put(tmp_path / "bad.csv", "label_id\n1\n"))


def test_pano_list(spark, tmp_path):
    got = {r["pano_id"]: r for r in readers.pano_list(spark, put(tmp_path / "p.csv", "pano_id,width,height,has_labels\n007,,,\n8,5,6,No\n,1,1,t\ntutorial,1,1,t\n8,5,6,No\n")).collect()}
    assert {k: (r["width"], r["has_labels"]) for k, r in got.items()} == {"007": (None, True), "8": (5, False)}
    with pytest.raises(Exception, match="has_labels"):
        readers.pano_list(spark, put(tmp_path / "q.csv", "pano_id,has_labels\n1,maybe\n")).collect()


def test_logs_and_ledgers(spark, tmp_path):
    line = ",".join(["2024-01-02T03:04:05.6", *["1"] * 16, ""])
    log = readers.run_log(spark, put(tmp_path / "a.csv", "start_time" + ",x" * 17 + "\n" + line + "\nrubbish" + "," * 17 + "\n")).collect()
    assert [(r["city"], r["xml_success"], r["total_minutes"]) for r in log] == [("a", 1.0, None)]
    assert {r["pano_id"] for r in readers.ledger(spark, put(tmp_path / "l.csv", "p1,1\np2,0\np3\np4,1,9\np5,7\n")).collect()} == {"p1", "p2"}
    assert {r["pano_id"] for r in readers.id_list(spark, put(tmp_path / "i.txt", "a # b\n\n#c\n d \n")).collect()} == {"a", "d"}


def test_strict_json(spark):
    assert writers.strict_json(spark.sql("SELECT 1 AS b, CAST(NULL AS DOUBLE) AS a")) == '[\n {\n  "a": null,\n  "b": 1\n }\n]\n'
    with pytest.raises(ValueError):
        writers.strict_json(spark.sql("SELECT CAST('NaN' AS DOUBLE) AS a"))


def test_narrow_exports_cities_and_intake(spark, tmp_path):
    header = "pano_id,label_type,pano_x,pano_y,pano_width,pano_height,time_created,other"
    got = readers.narrow_export(spark, put(tmp_path / "n.csv", f"{header}\n007,CurbRamp,1,2.5,,8192,1609459200000,x\n")).first()
    assert (got["pano_id"], got["pano_x"], got["pano_width"], str(got["time_created"])) == ("007", 1.0, None, "2021-01-01 00:00:00")
    assert [tuple(r) for r in readers.cities(spark, put(tmp_path / "c.csv", "city_id,display_name\n oradell-nj ,\"Oradell, NJ\"\n")).collect()] == [("oradell-nj", "Oradell, NJ")]
    text = "label_id,pano_id,pano_x,pano_y,label_type_id\n5,b,9,9,1\n5,a,1,1,1\n6,c,2,2,1\n,d,1,1,1\n"
    kept, again = readers.label_intake(spark, put(tmp_path / "l.csv", text))
    assert sorted((r["label_id"] or 0, r["pano_id"]) for r in kept.collect()) == [(0, "d"), (5, "b"), (6, "c")]
    assert [tuple(r) for r in again.collect()] == [(5, 2)]
    kept, _ = readers.label_intake(spark, put(tmp_path / "l.json", '[{"label_id": 7, "pano_id": "x", "pano_x": 1, "pano_y": 2, "label_type_id": 3}]'))
    assert kept.first()["label_id"] == 7
    with pytest.raises(ValueError, match="neither"):
        readers.label_intake(spark, "labels.txt")
    found = {r["file"]: (r["bytes"], r["rows"]) for r in readers.provenance(spark, str(tmp_path / "l.csv")).collect()}
    assert found == {"l.csv": (len(text), 4)}


def test_rigs_and_bundles(spark, tmp_path):
    rows = [("a", "gsv"), ("a", "gsv"), ("b", "mapillary"), ("validation-study", "gsv")]
    kept, left_out = readers.one_rig(spark.createDataFrame(rows, "city string, pano_source string"), "gsv")
    assert {r["city"] for r in kept.collect()} == {"a"} and kept.count() == 2
    assert {(r["city"], r["reason"]) for r in left_out.collect()} == {("b", "other source"), ("validation-study", "not a population")}
    with pytest.raises(Exception, match="mixed sources"):
        readers.one_rig(spark.createDataFrame([("a", "gsv"), ("a", "mapillary")], "city string, pano_source string"), "gsv")[0].collect()
    boxes = put(tmp_path / "b.json", '{"p": {"status": "boxed", "point": {"x": 0.5, "y": 0.25}, "w": 0.1, "h": 0.2, "cx": 0.5, "cy": 0.5}, "q": {"status": "skipped"}}')
    frames = put(tmp_path / "f.json", '{"pano_id": "p", "width": 1000, "height": 500}\n')
    assert [(r["pano_id"], r["x"], r["y"], r["box_w"]) for r in readers.bundle(spark, boxes, frames).collect()] == [("p", 500.0, 125.0, 100.0)]


def test_writers(spark, tmp_path):
    df = spark.sql("SELECT 'x' AS city, CAST('NaN' AS DOUBLE) AS b, 1.5D AS a, CAST(NULL AS STRING) AS c")
    assert writers.records(df).first()["value"] == '{"a":1.5,"b":null,"c":null,"city":"x"}'
    writers.csv_by_city(df, str(tmp_path / "by"))
    assert [p.suffix for p in (tmp_path / "by" / "city=x").glob("part-*")] == [".gz"]
    log = str(tmp_path / "log")
    writers.append_runs(spark.sql("SELECT '2024-01-02T03:04:05' AS start_time, 3D AS xml_success"), log)
    writers.append_runs(spark.sql("SELECT '2024-01-03T03:04:05' AS start_time, 4D AS xml_success"), log)
    assert sorted(r["xml_success"] for r in readers.run_log(spark, log).collect()) == [3.0, 4.0]
    with pytest.raises(ValueError, match="not in the log"):
        writers.append_runs(spark.sql("SELECT '2024-01-03T03:04:05' AS start_time, 4D AS weather"), log)
    both = writers.united(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS b, 3 AS a"))
    assert both.columns == ["a", "b"] and {tuple(r) for r in both.collect()} == {(1, None), (3, 2)}
    notes = spark.createDataFrame([("me", "c:1", i, i, f"p{i}", "b", "f", f"n{i}") for i in (1, 2, 3)], "annotator string, label_uid string, saved_at int, entry int, point string, box string, flags string, notes string")
    now = writers.with_history(notes).first()
    assert (now["revision"], now["notes"], [x["notes"] for x in now["superseded"]]) == (3, "n3", ["n1", "n2"])


def test_outcomes_that_come_twice_enter_once(spark, tmp_path):
    from gnomon.streaming.ledger import new_outcomes

    folder = tmp_path / "in"
    rows = [("p1", "saved", "2024-01-01 00:00:00"), ("p1", "saved", "2024-01-01 01:00:00"), ("p2", "saved", "2024-01-01 00:30:00"), ("p1", "unavailable", "2024-01-01 02:00:00")]
    spark.createDataFrame(rows, "pano_id string, status string, at string").selectExpr("pano_id", "status", "CAST(at AS TIMESTAMP) AS at").write.parquet(str(folder))
    stream = new_outcomes(spark.readStream.schema("pano_id string, status string, at timestamp").parquet(str(folder)))
    stream.writeStream.format("memory").queryName("outcomes").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["pano_id"], r["status"]) for r in spark.table("outcomes").collect()) == [("p1", "saved"), ("p1", "unavailable"), ("p2", "saved")]
