"""Raster cores: masks, regions, outlines and colours of one sheet or tile, with numpy only.

A sheet is a row of a DataFrame; ``per_sheet`` runs a core on each with
``mapInPandas``. Image decoding and text recognition are given as functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


# ------------------------------------------------------------------------------------------------- masks
def ink_mask(gray: np.ndarray, dark: int = 160, content: tuple[int, int, int, int] | None = None, blank: list[tuple[int, int, int, int]] = ()) -> np.ndarray:
    """Dark pixels inside the content box, without the boxes of read texts."""
    mask = gray < dark
    for x1, y1, x2, y2 in blank:
        mask[max(0, y1) : y2, max(0, x1) : x2] = False
    if content:
        x1, y1, x2, y2 = content
        outside = np.ones_like(mask)
        outside[y1:y2, x1:x2] = False
        mask[outside] = False
    return mask


def ink_share(gray: np.ndarray, dark: int = 160) -> float:
    return float((gray < dark).mean()) if gray.size else 0.0


def paper_extent(gray: np.ndarray, black: int = 40) -> tuple[int, int, int, int]:
    """The box of rows and columns that are mostly not black."""
    light = gray > black
    rows, columns = np.flatnonzero(light.mean(1) > 0.5), np.flatnonzero(light.mean(0) > 0.5)
    if not len(rows) or not len(columns):
        return 0, 0, gray.shape[1], gray.shape[0]
    return int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1


def squared_distance(mask: np.ndarray) -> np.ndarray:
    """Squared distance of every set pixel to the nearest clear one, exactly: by columns, then by rows."""
    far = float(sum(mask.shape) ** 2)
    height = np.where(mask, np.inf, 0.0)
    for y in range(1, len(height)):
        height[y] = np.minimum(height[y], height[y - 1] + 1)
    for y in range(len(height) - 2, -1, -1):
        height[y] = np.minimum(height[y], height[y + 1] + 1)
    column = np.minimum(height**2, far)
    out = column.copy()
    for shift in range(1, mask.shape[1]):
        if shift * shift > out.max():
            break
        out[:, shift:] = np.minimum(out[:, shift:], column[:, :-shift] + shift * shift)
        out[:, :-shift] = np.minimum(out[:, :-shift], column[:, shift:] + shift * shift)
    return out


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    """Pixels whose disc lies in the mask; what is beyond the edge counts as clear."""
    framed = np.pad(mask, 1)
    return (squared_distance(framed) > radius * radius)[1:-1, 1:-1]


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    if not mask.any():
        return mask.copy()
    return squared_distance(~mask) <= radius * radius


def opened(mask: np.ndarray, radius: int) -> np.ndarray:
    return dilate(erode(mask, radius), radius)


def closed(mask: np.ndarray, radius: int) -> np.ndarray:
    framed = np.pad(mask, radius + 1)
    return erode(dilate(framed, radius), radius)[radius + 1 : -radius - 1, radius + 1 : -radius - 1]


# ------------------------------------------------------------------------------------------------- regions
def label_regions(mask: np.ndarray, diagonal: bool = False) -> tuple[np.ndarray, int]:
    """Connected regions numbered from 1 in reading order: runs of a row are joined to those they touch in the row above."""
    height, width = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    parent = np.arange(len(row))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(height + 1))
    reach = 1 if diagonal else 0
    for y in range(1, height):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] < end[j] + reach and start[j] < end[i] + reach:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(i) for i in range(len(row))], int)
    names, number = np.unique(roots, return_inverse=True)
    out = np.zeros(mask.shape, np.int32)
    for y, s, e, n in zip(row, start, end, number, strict=True):
        out[y, s:e] = n + 1
    return out, len(names)


def grow(labels: np.ndarray, mask: np.ndarray, rounds: int) -> np.ndarray:
    """Labels spread over the mask from their rims, one pixel in eight directions a round; of two that meet the larger number wins."""
    width = labels.shape[1] + 2
    out, free = np.pad(labels, 1).ravel(), np.pad(mask, 1).ravel()
    steps = np.array([dy * width + dx for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx])
    rim = np.flatnonzero(out)
    while rounds and len(rim):
        to, of = (rim[:, None] + steps).ravel(), np.repeat(out[rim], len(steps))
        open_ = free[to] & (out[to] == 0)
        rim = np.unique(to[open_])
        reached = np.zeros_like(out)
        np.maximum.at(reached, to[open_], of[open_])
        out[rim] = reached[rim]
        rounds -= 1
    return out.reshape(-1, width)[1:-1, 1:-1]


def split_necks(white: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Regions parted at passages narrower than twice the radius, and which of them have a core."""
    cores, wide = label_regions(erode(white, radius))
    with_rims = grow(cores, white, radius + 2)
    narrow, slim = label_regions(white & ~with_rims.astype(bool))
    return with_rims + np.where(narrow > 0, narrow + wide, 0), np.repeat([True, False], [wide, slim])


def contact(labels: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], int]]:
    """Boundary lengths of regions, and shared ones of pairs."""
    boundary = np.zeros(labels.max() + 1, np.int64)
    shared: dict[tuple[int, int], int] = {}
    for a, b in ((labels[1:], labels[:-1]), (labels[:, 1:], labels[:, :-1])):
        differ = a != b
        pairs, count = np.unique(np.stack([a[differ], b[differ]], 1), axis=0, return_counts=True) if differ.any() else (np.empty((0, 2), int), [])
        for (x, y), n in zip(pairs, count, strict=True):
            boundary[x] += n
            boundary[y] += n
            if x and y:
                shared[int(x), int(y)] = shared.get((int(x), int(y)), 0) + int(n)
                shared[int(y), int(x)] = shared.get((int(y), int(x)), 0) + int(n)
    return boundary, shared


def enclosed_white(ink: np.ndarray, content: tuple[int, int, int, int], neck: int = 0, open_share: float = 0.10, largest: float = 0.2) -> np.ndarray:
    """White regions that are not street space, numbered; 0 elsewhere.

    Street space touches the content's border or is larger than a share of the
    content. With a neck, regions are first parted at narrow passages, and the
    street space then takes back what opens to it widely or has no core.
    """
    x1, y1, x2, y2 = content
    white = np.zeros_like(ink)
    white[y1:y2, x1:x2] = ~ink[y1:y2, x1:x2]
    labels, core = split_necks(white, neck) if neck else (lambda r: (r[0], np.ones(r[1], bool)))(label_regions(white))
    size = np.bincount(labels.ravel(), minlength=len(core) + 1)
    street = np.zeros(len(core) + 1, bool)
    street[np.unique(np.concatenate([labels[y1, x1:x2], labels[y2 - 1, x1:x2], labels[y1:y2, x1], labels[y1:y2, x2 - 1]]))] = True
    street |= size > largest * (x2 - x1) * (y2 - y1)
    street[0] = False
    if neck:
        boundary, shared = contact(labels)
        changed = True
        while changed:
            open_to = np.zeros(len(street))
            for (a, b), n in shared.items():
                if street[b] and not street[a]:
                    open_to[a] += n
            thin = np.concatenate([[False], ~core])
            new = ~street & ((open_to > open_share * np.maximum(boundary, 1)) | (thin & (open_to > 0)))
            changed = bool(new.any())
            street |= new
    keep = np.cumsum(~street) - 1
    keep[street] = 0
    keep[0] = 0
    return keep[labels]


# ------------------------------------------------------------------------------------------------- outlines
def outline(mask: np.ndarray) -> np.ndarray:
    """Corners of the outer boundary of a region, clockwise, found by walking its pixel edges with the region on the right."""
    framed = np.pad(mask, 1)
    ys, xs = np.nonzero(framed)
    if not len(ys):
        return np.empty((0, 2), int)
    y, x = int(ys[0]), int(xs[ys == ys[0]].min())
    start, heading = (x, y), 0
    step = [(1, 0), (0, 1), (-1, 0), (0, -1)]
    at = lambda px, py: bool(framed[py, px])
    out, (px, py) = [], start
    while True:
        # the pixels ahead on the left and right of the edge point
        ahead = {0: ((px, py - 1), (px, py)), 1: ((px, py), (px - 1, py)), 2: ((px - 1, py), (px - 1, py - 1)), 3: ((px - 1, py - 1), (px, py - 1))}[heading]
        left, right = at(*ahead[0]), at(*ahead[1])
        turn = -1 if left else (0 if right else 1)
        if turn:
            out.append((px - 1, py - 1))
            heading = (heading + turn) % 4
            if left is False and (px, py) == start and heading == 0 and len(out) > 1:
                break
            if turn == 1:
                continue
        px, py = px + step[heading][0], py + step[heading][1]
        if (px, py) == start and heading == 3:
            out.append((px - 1, py - 1))
            break
        if len(out) > 4 * framed.size:
            raise RuntimeError("outline does not close")
    return np.array(out)


def simplify(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Vertices that a line may not leave out (recursive farthest point), ends kept."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    work = [(0, len(points) - 1)]
    while work:
        i, j = work.pop()
        if j - i < 2:
            continue
        run = (points[j] - points[i]).astype(float)
        rel = points[i + 1 : j] - points[i]
        length = np.hypot(*run)
        far = np.abs(rel[:, 0] * run[1] - rel[:, 1] * run[0]) / length if length else np.hypot(*rel.T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            work += [(i, i + 1 + k), (i + 1 + k, j)]
    return points[keep]


def stroke_width(mask: np.ndarray) -> float:
    """Twice the largest distance inside a stroke."""
    return 2 * float(np.sqrt(squared_distance(np.pad(mask, 1)).max())) if mask.any() else 0.0


def paint_lines(shape: tuple[int, int], lines: np.ndarray, width: float) -> np.ndarray:
    """Pixels within half a width of segments (n, 2, 2) in x, y."""
    out = np.zeros(shape, bool)
    half = width / 2
    for (ax, ay), (bx, by) in np.asarray(lines, float).reshape(-1, 2, 2):
        x1, x2 = int(max(0, min(ax, bx) - half - 1)), int(min(shape[1], max(ax, bx) + half + 2))
        y1, y2 = int(max(0, min(ay, by) - half - 1)), int(min(shape[0], max(ay, by) + half + 2))
        if x1 >= x2 or y1 >= y2:
            continue
        x, y = np.meshgrid(np.arange(x1, x2), np.arange(y1, y2))
        dx, dy = bx - ax, by - ay
        u = np.clip(((x - ax) * dx + (y - ay) * dy) / max(dx * dx + dy * dy, 1e-9), 0, 1)
        out[y1:y2, x1:x2] |= np.hypot(x - ax - u * dx, y - ay - u * dy) <= half
    return out


def cut_region(mask: np.ndarray, lines: np.ndarray, width: float, least: int) -> tuple[np.ndarray, int]:
    """Parts of a region left between painted lines, the small ones dropped."""
    labels, n = label_regions(mask & ~paint_lines(mask.shape, lines, width))
    size = np.bincount(labels.ravel(), minlength=n + 1)
    good = np.flatnonzero(size[1:] >= least) + 1
    name = np.zeros(n + 1, np.int32)
    name[good] = np.arange(1, len(good) + 1)
    return name[labels], len(good)


# ------------------------------------------------------------------------------------------------- colours
def lab(rgb: np.ndarray) -> np.ndarray:
    """CIE L*a*b* (D65) of 8-bit sRGB."""
    c = rgb.astype(float) / 255
    linear = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    # sRGB primaries and the D65 white.
    xyz = linear @ np.array([[0.4124564, 0.3575761, 0.1804375], [0.2126729, 0.7151522, 0.0721750], [0.0193339, 0.1191920, 0.9503041]]).T / np.array([0.95047, 1.0, 1.08883])
    f = np.where(xyz > 216 / 24389, np.cbrt(xyz), (24389 / 27 * xyz + 16) / 116)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], -1)


def hue_chroma(values: np.ndarray, paper: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in degrees, chroma and lightness difference against the paper."""
    d = values - paper
    return np.degrees(np.arctan2(d[..., 2], d[..., 1])) % 360, np.hypot(d[..., 1], d[..., 2]), d[..., 0]


# ------------------------------------------------------------------------------------------------- frames
def per_sheet(sheets: DataFrame, core: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """A row per sheet of (sheet, width, height, pixels): 8-bit gray rows in, the fields of ``schema`` out."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"sheet": r.sheet} | core(np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width)) for r in pdf.itertuples()]
            yield pd.DataFrame(rows, columns=columns)

    return sheets.mapInPandas(run, schema)


def recognise(tiles: DataFrame, load: Callable[[], Callable[[bytes], str]]) -> DataFrame:
    """(tile, content): a text model over tile images; ``load`` is called once a partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            yield pd.DataFrame({"tile": pdf["tile"], "content": [model(x) for x in pdf["image"]]})

    return tiles.mapInPandas(run, "tile string, content string")
