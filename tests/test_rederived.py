"""Queries without SQL against plain loops over the same rows."""

import math
from itertools import combinations
from pathlib import Path

import pytest

from seamline import plans
from seamline.sources.views import view

DATA = Path("/root/testdata/sf0.001")
plans.load()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def rows(spark, name):
    return plans.QUERIES[name](spark, str(DATA)).collect()


def fixture(spark, name):
    return view(spark, str(DATA), name).collect()


def km(a, b):
    return math.hypot((a["lat"] - b["lat"]) * 111.32, (a["lon"] - b["lon"]) * 111.32 * math.cos(math.radians((a["lat"] + b["lat"]) / 2)))


def covered(hits, reach=6.0):
    """Places of one name: each hit not within reach of an earlier place's hit opens one."""
    opened = []
    for h in sorted(hits, key=lambda h: h["hit_id"]):
        if all(km(h, o) > reach for o in opened):
            opened.append(h)
    return len(opened)


def by(items, key):
    out = {}
    for x in items:
        out.setdefault(key(x), []).append(x)
    return out


def test_places_cover(spark):
    want = {name: covered(hits) for name, hits in by(fixture(spark, "v_hits"), lambda h: h["name"]).items()}
    assert {r["name"]: r["places"] for r in rows(spark, "places_cover")} == want


def test_cluster_places(spark):
    got = by(rows(spark, "cluster_places"), lambda r: r["sheet"])
    for sheet, hits in by(fixture(spark, "v_hits"), lambda h: h["hit_id"] // 500).items():
        weight = {n: 1 / math.sqrt(covered(h)) for n, h in by(hits, lambda h: h["name"]).items()}
        alive, of = {h["hit_id"]: h for h in hits}, by(got.get(sheet, []), lambda r: r["cluster"])
        for number in range(8):
            options = []
            for h in alive.values():
                names = {o["name"] for o in alive.values() if km(h, o) <= 6}
                if len(names) >= 2:
                    options.append((sum(weight[n] for n in names), -h["hit_id"]))
            if not options:
                assert number not in of
                break
            score = max(s for s, _ in options)
            seed = alive[min(-i for s, i in options if s >= score - 1e-12)]
            members = {i for i, h in alive.items() if km(h, seed) <= 6}
            held = {alive[i]["name"] for i in members}
            members |= {i for i, h in alive.items() if h["name"] not in held and any(km(h, alive[m]) <= 6 for m in members)}
            assert {r["hit_id"] for r in of[number]} == members
            assert of[number][0]["score"] == pytest.approx(sum(weight[n] for n in {alive[i]["name"] for i in members}), abs=1e-5)
            alive = {i: h for i, h in alive.items() if i not in members}


def test_merge_boxes(spark):
    want = {}
    for sheet, hits in by(fixture(spark, "v_hits"), lambda h: h["hit_id"] % 20).items():
        boxes = {}
        for h in sorted(hits, key=lambda h: h["hit_id"]):
            i = h["hit_id"]
            box = (h["lat"], h["lon"], h["lat"] + i % 7 * 0.0625, h["lon"] + i % 5 * 0.0625)
            into = next((k for k, (s, w, n, e) in boxes.items() if box[0] <= n and s <= box[2] and box[1] <= e and w <= box[3]), None)
            if into is None:
                boxes[i] = box
            else:
                old = boxes[into]
                boxes[into] = (min(old[0], box[0]), min(old[1], box[1]), max(old[2], box[2]), max(old[3], box[3]))
            want[sheet, i] = i if into is None else into
    assert {(r["sheet"], r["box_id"]): r["into"] for r in rows(spark, "merge_boxes")} == want


def test_dedupe_tokens(spark):
    got = {r["tok_id"]: (r["kind"], r["dup_of"]) for r in rows(spark, "dedupe_tokens")}

    def iou(a, b):
        w, h = min(a["x2"], b["x2"]) - max(a["x1"], b["x1"]), min(a["y2"], b["y2"]) - max(a["y1"], b["y1"])
        area = lambda t: (t["x2"] - t["x1"]) * (t["y2"] - t["y1"])
        return w * h / max(area(a) + area(b) - w * h, 1) if w > 0 and h > 0 else 0.0

    mid = lambda t: ((t["x1"] + t["x2"]) / 2, (t["y1"] + t["y2"]) / 2)
    short = lambda t: max(4, min(t["x2"] - t["x1"], t["y2"] - t["y1"]))
    want = {}
    for tokens in by(fixture(spark, "v_tokens"), lambda t: t["sheet"]).values():
        order = sorted(tokens, key=lambda t: (t["rotation"] != 0, -t["edge_margin"], t["tile"], t["tok_id"]))
        kind = {}
        for i, t in enumerate(order):
            for o in order[:i]:
                same = o["text"].lower() == t["text"].lower() and o["tile"] != t["tile"] and o["tok_id"] not in kind
                if same and (iou(t, o) >= 0.4 or math.dist(mid(t), mid(o)) <= 0.8 * max(short(t), short(o))):
                    kind[t["tok_id"]] = ("duplicate", o["tok_id"])
                    break
        kept = [t for t in order if t["tok_id"] not in kind]
        for t in kept:
            for o in kept:
                inside = o["x1"] - 4 <= mid(t)[0] <= o["x2"] + 4 and o["y1"] - 4 <= mid(t)[1] <= o["y2"] + 4
                if o["tok_id"] not in kind and o["tile"] != t["tile"] and len(o["text"]) > len(t["text"]) and t["text"].lower() in o["text"].lower() and inside:
                    kind[t["tok_id"]] = ("fragment", o["tok_id"])
                    break
        for i, t in enumerate(kept):
            for o in kept[:i]:
                if t["tok_id"] not in kind and o["tok_id"] not in kind and o["tile"] != t["tile"] and o["text"].lower() != t["text"].lower() and iou(t, o) >= 0.5:
                    kind[t["tok_id"]] = ("conflict", o["tok_id"])
                    break
        want |= {t["tok_id"]: kind.get(t["tok_id"], ("kept", None)) for t in order}
    assert {i: k for i, (k, _) in got.items()} == {i: k for i, (k, _) in want.items()}
    assert {i for i, (k, _) in want.items() if k == "duplicate"} and {k for k, _ in want.values()} >= {"kept", "duplicate", "conflict"}


def test_collinear_rows(spark):
    got = by(rows(spark, "collinear_rows"), lambda r: r["sheet"])
    for sheet, labels in by(fixture(spark, "v_labels"), lambda r: r["sheet"]).items():
        left = {r["label_id"]: (r["px"], r["py"]) for r in labels}
        told = by(got[sheet], lambda r: r["row"])
        for number in range(3):
            most = 0
            for (x1, y1), (x2, y2) in combinations(left.values(), 2):
                length = math.hypot(x2 - x1, y2 - y1)
                if length >= 40:
                    most = max(most, sum(abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) / length <= 20 for x, y in left.values()))
            assert len(told.get(number, [])) == (most if most >= 4 else 0)
            left = {i: p for i, p in left.items() if i not in {r["point_id"] for r in told.get(number, [])}}


def test_fits_and_tints(spark):
    labels = by(fixture(spark, "v_labels"), lambda r: r["sheet"])
    fits = {r["sheet"]: r for r in rows(spark, "fit_pose")}
    for sheet, r in fits.items():
        assert r["labels"] <= len(labels[sheet])
        assert r["status"] == ("refused_min_labels" if r["labels"] < 6 else "placed")
        assert r["status"] != "placed" or (4 <= r["inliers"] <= r["labels"] and r["rms"] >= 0 and r["model"] in ("affine", "similarity"))
    for r in rows(spark, "kmeans_tints"):
        assert 0 <= r["tint"] < 4 and min(abs(r["angle"] - math.degrees(math.atan2(r["b"], r["a"])) % 360), 360 - abs(r["angle"] - math.degrees(math.atan2(r["b"], r["a"])) % 360)) <= 1.1
