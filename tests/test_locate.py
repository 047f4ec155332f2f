"""Facts about the way from names to places, placed sheets and run folders."""

import json

import pytest
from pyspark.sql import functions as F

from seamline.operators import judgements, locate, sheets, streets, summaries, tokens
from seamline.sources import layers, runs


def reads(spark, texts, in_block=()):
    return spark.createDataFrame([(1, i, t, i in in_block) for i, t in enumerate(texts)], "sheet int, tok_id long, text string, in_block boolean")


def asked(df):
    return {r["name"]: r for r in df.where("reason IS NULL").collect()}


def test_tiers_and_queries(spark):
    found = locate.selection(reads(spark, ["ALPHA ST.", "ALPHA", "BETA ST", "GAMMA", "GAMMA", "Delta", "EPSILON", "ETA", "ZETA BLK"]))
    by = asked(found)
    assert (by["ALPHA"]["typ"], by["ALPHA"]["occurrences"], by["ALPHA"]["tier"], by["ALPHA"]["query"]) == ("ST", 2, "A", "Alpha Street")
    assert by["GAMMA"]["tier"] == "B" and by["GAMMA"]["type_assumed"] == "ST" and by["GAMMA"]["query"] == "Gamma Street" and by["EPSILON"]["tier"] == "B"
    assert {r["name"]: r["reason"] for r in found.where("reason IS NOT NULL").collect()} == {"DELTA": "bare_tier_C"}
    assert max(by.values(), key=lambda r: r["rank"])["name"] == "ALPHA"


def test_bare_modes_forced_and_dropped_names(spark):
    some = reads(spark, ["ALPHA ST", "Delta"])
    assert set(asked(locate.selection(some, "all"))) == {"ALPHA", "DELTA"}
    assert set(asked(locate.selection(some, "none"))) == {"ALPHA"}
    found = locate.selection(some, force=("Omega Road",), drop=("ALPHA ST",))
    assert {n: r["query"] for n, r in asked(found).items()} == {"OMEGA": "Omega Road"}
    assert found.where("reason = 'dropped'").count() == 1
    assert {r["name"] for r in locate.selection(reads(spark, ["ALPHA ST", "BETA ST"], {0})).collect()} == {"BETA"}
    many = locate.selection(reads(spark, [f"{a}{b}LEY ST" for a in "BCDFG" for b in "AEIOU"]), most=7)
    assert many.where("reason IS NULL").count() == 7 and many.where("reason = 'over_max'").count() == 18


def test_long_ways_count_as_points(spark):
    rows = [(1, 10.0, 10.0, 9.99, 9.99, 10.01, 10.01), (1, 10.1, 10.1, 9.0, 9.0, 11.0, 11.0)]
    box = locate.candidate_boxes(spark.createDataFrame(rows, "candidate int, lat double, lon double, s double, w double, n double, e double"), 0.0).first()
    assert (box["s"], box["w"], box["n"], box["e"]) == (9.99, 9.99, 10.1, 10.1)


def test_ids_and_boxes(spark):
    row = spark.range(1).select(
        locate.catalogue_id(F.lit("x/g3934tm.g3934tm_g013521884/")).alias("c"), locate.catalogue_id(F.lit("g3934tm.g3935tm_g01")).alias("none"), locate.plan_stem(F.lit("g3934tm_g013521884")).alias("stem"),
        locate.storage_path(F.lit("g3934tm"), F.lit("i")).alias("path"), locate.parsed_box(F.lit("1,2,3,4")).alias("box"), locate.parsed_box(F.lit("3,2,1,4")).alias("turned"), locate.parsed_box(F.lit("1,2,x,4")).alias("bad"),
        locate.sheet_number(F.lit("01352_1889-0003")).alias("number"), runs.utc(F.lit("2026-01-02T03:04:05+00:00")).alias("utc"), runs.utc(F.lit("soon")).alias("no_utc"), runs.relative(F.lit("/a/b/c"), "/a").alias("rel"),
        sheets.parsed_epsg(F.lit("urn:ogc:def:crs:EPSG::26910")).alias("epsg"), sheets.parsed_epsg(F.lit("urn:ogc:def:crs:OGC:1.3:CRS84")).alias("degrees"), sheets.crs_status(F.lit(2193)).alias("status"),
    ).first()
    assert tuple(row["c"]) == ("g3934tm", "g3934tm_g013521884") and row["none"] is None and row["stem"] == "01352_1884" and row["path"] == "gmd/gmd393m/g3934m/g3934tm/i"
    assert tuple(row["box"]) == (1.0, 2.0, 3.0, 4.0) and row["turned"] is None and row["bad"] is None and row["number"] == "3"
    assert row["utc"].year == 2026 and row["no_utc"] is None and row["rel"] == "b/c" and (row["epsg"], row["degrees"], row["status"]) == (26910, 4326, "refused_crs")


def test_repeated_tail_by_trying_every_length():
    def slow(text, least=40, times=10):
        n = len(text)
        for size in range(2, n // times + 1) if n >= least else ():
            count, at = 0, n - size
            while at >= 0 and text[at : at + size] == text[n - size :]:
                count, at = count + 1, at - size
            if count >= times:
                return text[: n - size * (count - 1)]
        return text

    for text in ("ab" * 40, "x" + "abc" * 30, "abab" * 9 + "z", "head " + ("ab" * 3 + "c") * 12, "a" * 100, "short", "aab" * 9 + "aab", "ab" * 9 + "cdcd" * 12):
        assert text[: judgements.tail_start(text, 40)] == slow(text)
    assert judgements.tail_start("ab" * 20000) == 2


def test_lonely_label(spark):
    segments = spark.createDataFrame([(1, "A ST", 0.0, 0.0, 100.0, 0.0), (2, "B ST", 0.0, 50.0, 100.0, 50.0), (3, "C ST", 5000.0, 0.0, 5100.0, 0.0)], "seg_id long, street string, ax double, ay double, bx double, by_ double")
    matched = spark.createDataFrame([(1, 1, "A ST"), (1, 2, "B ST"), (1, 3, "C ST"), (2, 4, "C ST"), (3, 5, "A ST"), (3, 5, "C ST")], "sheet int, label_id long, street string")
    got = {r["label_id"]: r["alone"] for r in streets.lonely(matched, segments, 300.0).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False}  # one street on a sheet, or all of one label, is not alone


def test_tint_names(spark):
    rows = spark.createDataFrame([(1, 0, 35), (1, 1, 325), (1, 2, 130), (1, 3, 131), (1, 4, 300), (1, 5, 301)], "sheet int, tint int, angle int")
    assert {r["tint"]: r["name"] for r in judgements.tint_names(rows).collect()} == {0: "pink1", 1: "pink2", 2: "yellow", 3: "green", 4: "blue", 5: "purple"}


def test_readers_of_a_run(spark, tmp_path):
    (tmp_path / "b" / "c").mkdir(parents=True)
    (tmp_path / "a").mkdir()
    for p in ("a/s1_tiles.json", "b/c/s2_tiles.json", "b/other.json"):
        (tmp_path / p).write_text("{}")
    found = runs.run_folders(spark, str(tmp_path)).collect()
    assert [(r["folder"].rsplit("/", 1)[1], r["stem"]) for r in found] == [("a", "s1"), ("c", "s2")]
    made = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"StreetName1": "Alpha St", "STREET2": "Beta Ave"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"name1": "Gamma Rd", "name2": "Delta St"}, "geometry": {"type": "MultiPoint", "coordinates": [[3, 4], [5, 6]]}},
        {"type": "Feature", "properties": {"name1": "Lone St", "name2": ""}, "geometry": {"type": "Point", "coordinates": [7, 8]}},
    ]}
    (tmp_path / "x.geojson").write_text(json.dumps(made))
    got = runs.crossings(layers.geojson_features(spark, str(tmp_path / "x.geojson"))).collect()
    assert sorted((r["x"], r["y"], *r["names"]) for r in got) == [(1.0, 2.0, "ALPHA ST", "BETA AVE"), (3.0, 4.0, "GAMMA RD", "DELTA ST")]
    polygon = [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [1, 1]]]
    rings = spark.createDataFrame([(1, "Polygon", json.dumps(polygon)), (2, "MultiPolygon", json.dumps([polygon, polygon])), (3, "Point", "[1, 2]")], "feature int, kind string, coordinates string")
    assert sorted((r["feature"], r["part"], len(r["ring"])) for r in runs.block_rings(rings).collect()) == [(1, 0, 4), (2, 0, 4), (2, 1, 4)]
    (tmp_path / "lines.json").write_text(json.dumps({"lines": [{"id": 3, "bbox_xyxy": [1, 2, 3, 4], "confidence": 0.5}]}))
    assert tuple(runs.detected_lines(spark, str(tmp_path / "lines.json")).first()) == (3, 1.0, 2.0, 3.0, 4.0, 0.5)
    (tmp_path / "key.json").write_text(json.dumps({"materials": [{"name": "brick", "colour": "Rot"}, {"name": "iron", "hue_deg": [200, 220]}]}))
    assert [tuple(r) for r in runs.legend(spark, str(tmp_path / "key.json")).collect()] == [(0, "brick", "rot", None, None), (1, "iron", None, 200.0, 220.0)]


def test_log_is_only_added_to(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "event_id long, stage string, finished string, elapsed_s double, run string"
    rows = [(1, "ocr", "2026-01-01", 3.0, "r1"), (2, "fit", None, None, "r1")]
    runs.append_events(spark.createDataFrame(rows[:1], schema), path)
    runs.append_events(spark.createDataFrame(rows[1:], schema), path)
    got = runs.read_events(spark, path, schema)
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2]
    body = runs.history(got.withColumn("status", F.lit("ok"))).first()["body"]
    assert body.startswith("# Run r1\n\n2 events, 2 stages, 3.0 s") and body.endswith("| ocr | ok | 2026-01-01 | 3.0 |")
    wide = runs.log_table(spark.createDataFrame([(1, "zeta", "9"), (1, "stage", "ocr"), (2, "alpha", "x")], "event_id long, key string, value string"), ["zeta", "stage", "alpha"])
    assert wide.columns == ["event_id", "stage", "alpha", "zeta"] and sorted(map(tuple, wide.collect())) == [(1, "ocr", "", "9"), (2, "", "x", "")]


def test_suggestions_and_labels_inside(spark):
    segments = spark.createDataFrame([(1, "OAK ST", 0.0, 0.0, 100.0, 0.0), (2, "ELM ST", 0.0, 60.0, 100.0, 60.0)], "seg_id long, street string, ax double, ay double, bx double, by_ double")
    rows = [(1, 1, "HAZEL", False, 50.0, 5.0), (1, 2, "HAZEL", False, 50.0, 57.0), (1, 3, "OAK", False, 50.0, 2.0), (1, 4, "BIRCH", True, 50.0, 1.0), (1, 5, "ASH 5", False, 9.0, 1.0), (1, 6, "STREET", False, 9.0, 1.0)]
    words = spark.createDataFrame(rows, "sheet int, point_id long, text string, in_block boolean, px double, py double")
    assert [(r["text"], r["street"], r["distance"], r["place"]) for r in sheets.alias_suggestions(words, segments, 20.0).collect()] == [("HAZEL", "ELM ST", 3.0, 1)]
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    rings = spark.createDataFrame([(1, ring), (2, [(x + 50, y) for x, y in ring])], "ring_id int, ring array<struct<x:double,y:double>>")
    labels = spark.createDataFrame([(1, 5.0, 5.0, False), (2, 6.0, 6.0, True), (3, 90.0, 90.0, False)], "label_id long, px double, py double, outlier boolean")
    assert sorted(map(tuple, sheets.labels_inside(labels, rings).collect())) == [(1, 1, 1), (2, 0, 0)]


def test_earlier_passes_are_numbered_anew(spark):
    kind = "sheet int, tok_id long, text string, tile string, dup_of long, fragment boolean, conflict boolean"
    one = spark.createDataFrame([(1, 0, "A", "t", None, False, False), (1, 1, "B", "t", 0, False, False)], kind)
    two = spark.createDataFrame([(1, 0, "C", "t", None, False, False), (1, 1, "D", "t", None, True, False)], kind)
    got = sorted(map(tuple, tokens.earlier_passes([("p1", one), ("p2", two)]).select("tok_id", "text", "tile").collect()))
    assert got == [(0, "A", "p1/t"), (1, "C", "p2/t")]


def test_recall_by_angle(spark):
    upright = spark.createDataFrame([(1, 1, "A"), (1, 2, "12")], "sheet int, tok_id long, text string")
    found = spark.createDataFrame([(1, 1, 30), (1, 2, 60), (1, 1, 60)], "sheet int, tok_id long, angle int")
    assert sorted(map(tuple, summaries.recall_by_angle(upright, found).collect())) == [(1, 30, 2, 0.5, 1.0), (1, 60, 2, 1.0, 1.0)]


@pytest.mark.parametrize("text, plain", [("Żołądź Őr", "Zoładz Or"), ("Straße ẞ", "Strasse SS"), ("ﬁne ½", "fine 1⁄2"), ("é é", "e e"), ("plain", "plain"), ("škoda ş Æ", "skoda s Æ")])
def test_folding(spark, text, plain):
    from seamline.functions import text as X

    assert spark.range(1).select(X.fold(F.lit(text)).alias("f")).first()["f"] == plain


def test_exact_spelling_can_be_asked_for(spark):
    from seamline.functions import text as X
    from seamline.operators import names

    labels, layer = spark.createDataFrame([("CARL ST",)], "text string"), spark.createDataFrame([("KARL ST",)], "street string")
    assert names.match_streets(labels, layer).count() == 1 and names.match_streets(labels, layer, exact=True).count() == 0
    assert spark.range(1).select(X.display_name(F.lit("Oak"), F.lit(None)).alias("d")).first()["d"] == "OAK"
