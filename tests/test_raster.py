import numpy as np
import pytest

from seamline.operators import raster


def sheet():
    """A frame, a closed block, a block with a gap of 12 pixels and dashed lot lines."""
    ink = np.zeros((600, 600), bool)
    box = lambda x1, y1, x2, y2: [(y1, slice(x1, x2 + 1)), (y2, slice(x1, x2 + 1)), (slice(y1, y2 + 1), x1), (slice(y1, y2 + 1), x2)]
    for b in (box(80, 80, 220, 220), box(330, 330, 500, 500)):
        for part in b:
            ink[part] = True
    ink[330, 400:412] = False
    for y in range(90, 210, 20):
        ink[y : y + 8, 150] = True
    return ink


def test_plain_rule_keeps_the_closed_block():
    found = raster.enclosed_white(sheet(), (8, 8, 592, 592))
    assert found[100, 100] > 0
    assert found[400, 400] == 0
    assert found[20, 20] == 0


def test_neck_recovers_the_leaky_block():
    found = raster.enclosed_white(sheet(), (8, 8, 592, 592), neck=16)
    assert found[100, 100] > 0
    assert found[415, 415] > 0
    assert found[20, 20] == 0


def test_distance_and_morphology_by_brute_force():
    rng = np.random.default_rng(3)
    mask = rng.random((23, 31)) < 0.8
    clear = np.argwhere(~mask)
    want = np.array([[((clear - [y, x]) ** 2).sum(1).min() for x in range(31)] for y in range(23)])
    assert (raster.squared_distance(mask) == want).all()
    grown = raster.dilate(mask, 2)
    assert (grown >= mask).all() and (raster.erode(mask, 2) <= mask).all()
    assert (raster.opened(mask, 1) <= mask).all() and (raster.closed(mask, 1) >= mask).all()


@pytest.mark.parametrize("diagonal", [False, True])
def test_regions_by_brute_force(diagonal):
    mask = np.random.default_rng(5).random((40, 37)) < 0.5
    labels, n = raster.label_regions(mask, diagonal)
    seen = np.zeros(mask.shape, int)
    count = 0
    for y, x in np.argwhere(mask):
        if seen[y, x]:
            continue
        count += 1
        todo = [(y, x)]
        while todo:
            a, b = todo.pop()
            if not (0 <= a < 40 and 0 <= b < 37) or not mask[a, b] or seen[a, b]:
                continue
            seen[a, b] = count
            todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (diagonal or not (i and j))]
    assert n == count
    assert len({(p, q) for p, q in zip(labels[mask], seen[mask], strict=True)}) == n


def area(points):
    x, y = points[:, 0], points[:, 1]
    return abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def test_outline_encloses_the_region():
    mask = np.zeros((30, 30), bool)
    mask[5:20, 4:25] = True
    mask[10:15, 4:9] = False
    ring = raster.outline(mask)
    assert area(ring) == mask.sum()
    assert len(raster.simplify(np.array([[0, 0], [1, 0.1], [2, 0], [2, 2]]), 0.5)) == 3


def test_strokes_cuts_and_colours():
    line = raster.paint_lines((60, 60), np.array([[[5, 30], [55, 30]]]), 9)
    assert abs(raster.stroke_width(line) - 10) <= 1
    parts, n = raster.cut_region(np.ones((60, 60), bool), np.array([[[0, 30], [60, 30]]]), 6, 100)
    assert n == 2 and parts[5, 5] != parts[55, 5]
    white = raster.lab(np.array([[255, 255, 255], [0, 0, 0]]))
    assert abs(white[0, 0] - 100) < 1e-3 and abs(white[1, 0]) < 1e-6 and abs(white[0, 1:]).max() < 0.02
    hue, chroma, _ = raster.hue_chroma(raster.lab(np.array([[255, 180, 180]])), white[0])
    assert hue[0] < 40 and chroma[0] > 20


def test_per_sheet(spark):
    gray = np.full((20, 30), 255, np.uint8)
    gray[5, :] = 0
    df = spark.createDataFrame([("s", 30, 20, bytearray(gray.tobytes()))], "sheet string, width int, height int, pixels binary")
    found = raster.per_sheet(df, lambda g: {"ink": raster.ink_share(g)}, "sheet string, ink double").collect()
    assert found[0]["ink"] == pytest.approx(30 / 600)
    out = raster.recognise(spark.createDataFrame([("t", bytearray(b"x"))], "tile string, image binary"), lambda: lambda image: f"{len(image)} bytes")
    assert out.first()["content"] == "1 bytes"
