"""Facts that matching, selection, clustering and fitting must reproduce."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seamline.functions import geo as G
from seamline.functions import text as X
from seamline.operators import fits, names, places, streets
from seamline.sources import layers, sinks


def told(spark, texts, column):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").orderBy("i").select(column(F.col("text"))).collect()]


def test_spelling(spark):
    pairs = [("THURMBERG", "TURMBERG"), ("CARL", "KARL"), ("FREYTAG", "FREITAG"), ("JOSEPHS", "JOSEFS")]
    for a, b in pairs:
        assert len(set(told(spark, [a, b], X.spell_key))) == 1
    assert told(spark, ["YATES", "CHURCH", "AYY"], X.spell_key) == ["YATES", "CHURCH", "AII"]


def test_labels(spark):
    got = told(spark, ["Yates Square", "Kronenstr", "Burnside Rd E", "Hoch-Straße", "Webster", "", "12", "Am Markt"], X.canon)
    assert got == ["YATES SQ", "KRONEN STRASSE", "BURNSIDE RD", "HOCH STRASSE", "WEBSTER", "", "", "AM MARKT"]


def test_numerals_and_floors(spark):
    assert told(spark, ["BLOCK 50", "16½", "YATES BLK", " 7 "], X.numeral) == ["50", "16½", None, "7"]
    rows = spark.createDataFrame([(0, ["2"]), (1, ["1½"]), (2, ["3"]), (3, ["4"]), (4, ["1", "2"]), (5, []), (6, ["1895"]), (7, ["3½"])], "i int, n array<string>")
    assert [r[0] for r in rows.orderBy("i").select(X.floors(F.col("n"))).collect()] == [2.0, 1.5, 3.0, None, None, None, None, None]


def match(spark, labels, streets_, aliases=None):
    a = spark.createDataFrame(aliases, "label string, streets array<string>") if aliases is not None else None
    out = names.match_streets(spark.createDataFrame([(x,) for x in labels], "text string"), spark.createDataFrame([(x,) for x in streets_], "street string"), a)
    return sorted(map(tuple, out.collect()))


def test_matching_ladder(spark):
    layer = ["KRONEN STRASSE", "AM HOCH MARKT", "WEST CORDOVA ST", "EAST CORDOVA ST", "MAIN ST", "MAIN AVE", "ALLEY"]
    assert match(spark, ["Kronen-Strasse", "KRONENSTRASSE"], layer) == [("KRONENSTRASSE", "KRONEN STRASSE"), ("Kronen-Strasse", "KRONEN STRASSE")]
    assert match(spark, ["Hochmarkt"], ["AM HOCH MARKT"]) == [("Hochmarkt", "AM HOCH MARKT")]
    assert match(spark, ["CORDOVA ST. WEST"], layer) == [("CORDOVA ST. WEST", "WEST CORDOVA ST")]
    assert match(spark, ["Main"], layer) == [("Main", "MAIN AVE"), ("Main", "MAIN ST")]
    assert match(spark, ["Main Street"], layer) == [("Main Street", "MAIN ST")]
    assert match(spark, ["ALLEY", "ST"], layer) == []


def test_aliases_rename_and_silence(spark):
    layer = ["MAIN ST", "FIRST AVE"]
    assert match(spark, ["Main", "Old Road"], layer, [("MAIN", []), ("OLD ROAD", ["FIRST AVE", "GONE ST"])]) == [("Old Road", "FIRST AVE")]


def test_fuzzy_takes_the_only_name(spark):
    layer = spark.createDataFrame([("BLANSHARD ST",), ("DOUGLAS ST",), ("STORE ST",)], "street string")
    labels = spark.createDataFrame([("OUGLAS",), ("BLANSHERD",), ("STONE",), ("DOUGLAS",)], "text string")
    assert sorted(map(tuple, names.fuzzy_streets(labels, layer).collect())) == [("BLANSHERD", "BLANSHARD"), ("OUGLAS", "DOUGLAS")]


def test_skip_reasons(spark):
    texts = ["YATES ST", "12", "AVE", "WHARF", "WHARF ST", "SMITH & CO", "ONE TWO THREE FOUR", "ABC", "PANDORA 12", "PANDORA"]
    got = told(spark, texts, lambda t: names.skip_reason(t, F.lit(False)))
    assert got == [None, "no_letters", "type_only", "furniture", None, "business", "business", "short", "digits", None]


def hits(rows):
    return pd.DataFrame([(i, *r) for i, r in enumerate(rows)], columns=["hit_id", "name", "lat", "lon"])


def test_places_and_clusters():
    lat, lon = np.full(38, 48.0) + np.arange(38) * 1e-4, np.full(38, -123.0)
    assert places.count_places(lat, lon, 6.0) == 1
    assert places.count_places(np.array([48.0, 49.0]), np.array([-123.0, -123.0]), 6.0) == 2
    common = [("e", 48.0, -123.0)] + [("e", 10.0 + i, 20.0) for i in range(39)]
    rare = [(n, 48.0, -123.0 + i * 0.01) for i, n in enumerate("abcd")]
    other = [(n, 30.0 + i * 0.01, 50.0) for i, n in enumerate("xyz")]
    out = places.cluster(hits(rare + common + other))
    best = out[out["cluster"] == 0]
    assert best["score"].iloc[0] == pytest.approx(4 + 1 / np.sqrt(40)) and best["name"].nunique() == 5
    assert out[out["cluster"] == 1]["name"].nunique() == 3
    assert places.cluster(hits([("a", 1.0, 1.0), ("b", 50.0, 1.0)])).empty


def test_radius_parts_or_joins():
    two = [(n, 48.0, -123.0) for n in "abc"] + [(n, 48.0 + 4 / 111.32, -123.0) for n in "def"]
    assert places.cluster(hits(two), 6.0)["cluster"].nunique() == 1
    assert places.cluster(hits(two), 2.0)["cluster"].nunique() == 2


def test_describe(spark):
    df = spark.createDataFrame([("s", "Victoria")] * 3 + [("s", "Esquimalt")] * 2, "key string, municipality string")
    assert tuple(places.describe(df, "key").first()) == ("s", "Victoria", "Esquimalt")


def test_pad_is_two_kilometres_tall(spark):
    s, _, n, _ = spark.range(1).select(*G.pad_box(F.lit(48.0), F.lit(-123.0), F.lit(48.0), F.lit(-123.0), 1.0)).first()
    assert (n - s) * 111.32 == pytest.approx(2.0)


def city(rng):
    """Streets of a skewed grid and labels read along them on a scan of known pose."""
    a = fits.pose(0.25, 20.0, (400.0, 900.0))
    inverse = np.linalg.inv(a[:, :2])
    ways, p, dirs = [], [], []
    for i in range(14):
        along = i % 2
        start = np.array([300.0 + 60 * i, 250.0]) if along else np.array([250.0, 300.0 + 60 * i])
        end = start + (np.array([30.0, 1000.0]) if along else np.array([1000.0, -40.0]))
        ways.append(np.array([[start, end]]))
        at = start + (end - start) * rng.uniform(0.2, 0.8)
        p.append(inverse @ (at - a[:, 2]))
        run = inverse @ (end - start)
        dirs.append(np.degrees(np.arctan2(run[1], run[0])) % 180)
    return a, np.array(p), ways, np.array(dirs)


def test_fit_recovers_a_planted_pose():
    rng = np.random.default_rng(1)
    a, p, ways, dirs = city(rng)
    seed = fits.pose(0.26, 24.0)
    seed[:, 2] = fits.moved(a, p).mean(0) + [12, -9] - seed[:, :2] @ p.mean(0)
    p = np.vstack([p, [[0.0, 0.0]]])
    ways.append(np.array([[[5000.0, 5000.0], [5100.0, 5000.0]]]))  # a name that is a street elsewhere
    dirs = np.append(dirs, np.nan)
    for d in (dirs, np.full(len(dirs), np.nan)):
        found = fits.fit_sheet(p, ways, [seed], d, fits.FitOptions(outlier_px=10.0))
        assert found["status"] == "placed" and found["inliers"] == 14
        assert found["rms"] < 0.5
        assert abs(found["scale_x"] - 0.25) < 0.01 and abs(found["rotation"] - 20) < 1
    assert fits.fit_sheet(p[:3], ways[:3], [seed], dirs[:3], fits.FitOptions())["status"] == "refused_min_labels"


def reads(rows):
    return pd.DataFrame([(0, i, *r) for i, r in enumerate(rows)], columns=["sheet", "tok_id", "text", "tile", "rotation", "edge_margin", "x1", "y1", "x2", "y2"])


def test_suppression():
    out = fits.suppress(
        reads(
            [
                ("Johnson", "a", 0, 30, 100, 100, 180, 120),
                ("JOHNSON", "b", 0, 5, 102, 101, 181, 121),
                ("ohnson", "c", 0, 2, 112, 100, 180, 120),
                ("Vicona", "d@30", 30, 50, 101, 100, 180, 121),
                ("Johnson", "a", 0, 30, 400, 100, 480, 120),
            ]
        )
    ).set_index("tok_id")
    assert out["kind"].to_dict() == {0: "kept", 1: "duplicate", 2: "fragment", 3: "conflict", 4: "kept"}
    assert out.loc[1, "dup_of"] == 0 and out.loc[2, "dup_of"] == 0 and out.loc[3, "dup_of"] == 0


def test_rows_and_tints():
    line = np.array([[i * 50.0, 100.0 + i] for i in range(6)])
    noise = np.array([[30.0, 900.0], [700.0, 500.0]])
    row = fits.rows_of(np.vstack([line, noise]))
    assert (row[:6] == 0).all() and (row[6:] == -1).all()
    rng = np.random.default_rng(0)
    cloud = np.vstack([rng.normal([30, 0], 1, (200, 2)), rng.normal([-10, 25], 1, (200, 2))])
    assert len(fits.tints(cloud)) == 2


def test_street_layer_reader(spark, tmp_path):
    (tmp_path / "l.json").write_text(
        '{"type":"FeatureCollection","features":['
        '{"type":"Feature","properties":{"name":"Yates Street"},"geometry":{"type":"LineString","coordinates":[[0,0],[1,0],[1,2]]}},'
        '{"type":"Feature","properties":{"name":"Fort"},"geometry":{"type":"MultiLineString","coordinates":[[[5,5],[6,5]],[[7,7],[8,8]]]}},'
        '{"type":"Feature","properties":{"name":""},"geometry":{"type":"LineString","coordinates":[[0,0],[9,9]]}},'
        '{"type":"Feature","properties":{"name":"Nowhere"},"geometry":null}]}'
    )
    got = layers.street_segments(layers.geojson_features(spark, str(tmp_path / "l.json"))).orderBy("street", "line", "part").collect()
    assert [(r["street"], r["line"], r["part"], r["bx"], r["by_"]) for r in got] == [("FORT", 0, 0, 6.0, 5.0), ("FORT", 1, 0, 8.0, 8.0), ("YATES ST", 0, 0, 1.0, 0.0), ("YATES ST", 0, 1, 1.0, 2.0)]
    with pytest.raises(ValueError, match="no field"):
        layers.pick_field(["a"], ["b"], "c")
    aliases = layers.alias_table(spark, '{"_note": ["x"], "old st": ["New Street"], "gone": []}').collect()
    assert {r["label"]: r["streets"] for r in aliases} == {"OLD ST": ["NEW ST"], "GONE": []}
    assert layers.epsg_of("urn:ogc:def:crs:EPSG::26910") == 26910 and layers.epsg_of("urn:ogc:def:crs:OGC:1.3:CRS84") == 4326


def page(offset, size):
    return [(i, f"f{i}") for i in range(offset, min(offset + size, 25))]


def test_paged_source(spark):
    spark.dataSource.register(layers.PagedFeatures)
    df = spark.read.format("paged").option("fetch", "tests.test_facts:page").option("total", 25).option("page", 10).load()
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3


def test_sheet_tokens_and_sinks(spark, tmp_path):
    (tmp_path / "s1_tiles.json").write_text('{"tokens":[{"id":1,"text":"a","dup_of":null},{"id":2,"text":"b","dup_of":1},{"id":3,"text":"c","fragment":true}]}')
    got = layers.sheet_tokens(spark, str(tmp_path / "*_tiles.json"))
    assert [(r["sheet"], r["id"]) for r in got.where("kept").collect()] == [("s1", 1)]
    sinks.write_tokens(got.select("id", "text", "fragment"), str(tmp_path / "csv"))
    assert sorted(map(tuple, spark.read.csv(str(tmp_path / "csv"), header=True).collect())) == [("1", "a", None), ("2", "b", None), ("3", "c", "1")]
    point = sinks.feature("Point", F.array(F.lit(1.0), F.lit(2.0)), F.struct(F.col("id")))
    rows = got.select((F.col("id") - 1).alias("ordinal"), point.alias("feature"))
    text = "".join(r["line"] for r in sinks.collection_lines(rows, "EPSG:32610").collect())
    import json

    assert [f["properties"]["id"] for f in json.loads(text)["features"]] == [1, 2, 3]


def test_depth_signs(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))))
    got = spark.range(1).select(G.ring_depth(F.lit(5.0), F.lit(4.0), ring), G.ring_depth(F.lit(-3.0), F.lit(5.0), ring)).first()
    assert tuple(got) == (4.0, -3.0)


def test_bounding_street_sides(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0))))
    rings = spark.range(1).select(F.col("id").alias("ring_id"), ring.alias("ring"))
    segments = spark.createDataFrame([("NORTH ST", -50.0, 48.0, 90.0, 48.0), ("FAR ST", -50.0, 300.0, 90.0, 300.0)], "street string, ax double, ay double, bx double, by_ double")
    got = streets.bounding_streets(rings, segments, 16.0, 0.08).collect()
    assert [(r["street"], r["side"], r["best"], r["share"]) for r in got] == [("NORTH ST", "N", 8.0, 0.5)]
