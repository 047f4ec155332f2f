"""Quality classifier: kernel ridge regression by random Fourier features, with isotonic calibration.

Each text is reduced to document statistics. Their cosines under random
projections approximate a Gaussian kernel; the normal equations of the ridge
fit are sums over partitions, so all labelled rows take part and only sums of a
fixed size travel. A fifth of the labelled rows is kept for the calibration:
their scores are counted in bins and pooled to a rising step function.

Defined cases: null and empty texts have zero statistics and get a score like
any other; labels that are null or have no document are not learned from; with
no labels all scores are 0.5; equal rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.common import Stash, id_mod, python_batches, table
from seamline.llm.shingles import run_hashes, word_hashes

#: Random features, kernel width, ridge penalty per row, bins of the calibration.
FOURIER, WIDTH, RIDGE, BINS = 128, 4.0, 1e-4, 1024
CLIP = 4.0
FIXED = float(1 << 20)
_SYMBOLS = b"#$%&*|<>{}[]\\~^=_+@"
_ENDINGS = b".!?"


def _share(values: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, and of the commonest one."""
    if not len(values):
        return 0.0, 0.0
    found = np.unique(values, return_counts=True)[1]
    return len(found) / len(values), found.max() / len(values)


def statistics(text: str | None) -> list[float]:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(len(data), 1)
    of = np.bincount(data, minlength=256)
    upper, lower, digit = of[65:91].sum(), of[97:123].sum(), of[48:58].sum()
    letters = upper + lower + of[128:].sum()
    marks = of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum()
    p = of[of > 0] / n
    words = word_hashes(text)
    count = max(len(words), 1)
    distinct, common = _share(words)
    runs, run = _share(run_hashes(words, 3))
    lines = (text or "").split("\n")
    long_lines = [x for x in lines if x.strip()]
    line_share = len(set(long_lines)) / max(len(long_lines), 1)
    return [
        np.log1p(len(words)),
        np.log1p(len(data) / count),
        letters / n,
        upper / max(upper + lower, 1),
        digit / n,
        marks / count,
        of[list(_SYMBOLS)].sum() / count,
        of[124] / count,
        of[33] / count,
        of[list(_ENDINGS)].sum() / count,
        of[10] / count,
        of[128:].sum() / n,
        distinct,
        common,
        runs,
        run,
        line_share,
        float(-(p * np.log(p)).sum()) if len(data) else 0.0,
        len(words) / max(len(long_lines), 1) / 100,
    ]


STATISTICS = len(statistics(""))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def partition_sums(df: DataFrame, of: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``of`` over all batches: one vector a partition is shuffled, in fixed point, so that order doesn't matter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += of(pdf)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"k": at, "v": np.rint(total[at] * FIXED).astype(np.int64)})

    found = df.mapInPandas(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[found["k"]] = found["v"].to_numpy(np.float64) / FIXED
    return out


def _features(x: np.ndarray, model: dict) -> np.ndarray:
    """Intercept, scaled statistics and random cosines."""
    scaled = np.clip((x - model["mean"]) / model["std"], -CLIP, CLIP)
    rng = np.random.default_rng(7)
    direction = rng.normal(size=(STATISTICS, FOURIER)) / WIDTH
    return np.hstack([np.ones((len(x), 1)), scaled / CLIP, np.cos(scaled @ direction + rng.uniform(0, 2 * np.pi, FOURIER))])


def _raw(x: np.ndarray, model: dict) -> np.ndarray:
    return np.clip(_features(x, model) @ model["w"], -0.5, 1.5)


def isotonic(value: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising block means at the blocks' mean positions."""
    blocks: list[list[float]] = []
    for v, m, w in zip(value, mean, weight, strict=True):
        blocks.append([v * w, m * w, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    done = np.array(blocks)
    return done[:, 0] / done[:, 2], done[:, 1] / done[:, 2]


def learn(rows: DataFrame) -> dict | None:
    """The model from rows of (fold, x, y); fold 0 calibrates, the others fit."""
    read = lambda pdf: np.stack(pdf["x"])
    sums = partition_sums(rows, lambda pdf: np.concatenate([[len(pdf)], read(pdf).sum(0), (read(pdf) ** 2).sum(0)]), 1 + 2 * STATISTICS)
    if not sums[0]:
        return None
    mean = sums[1 : 1 + STATISTICS] / sums[0]
    model = {"mean": mean, "std": np.sqrt(np.maximum(sums[1 + STATISTICS :] / sums[0] - mean**2, 1e-6))}
    size = 1 + STATISTICS + FOURIER
    upper = np.triu_indices(size)

    def normal(pdf: pd.DataFrame) -> np.ndarray:
        z, y = _features(read(pdf), model), pdf["y"].to_numpy(np.float64)
        return np.concatenate([(z.T @ z)[upper], z.T @ y])

    n = len(upper[0])
    found = partition_sums(rows.where("fold <> 0"), normal, n + size)
    gram = np.zeros((size, size))
    gram[upper] = found[:n]
    gram = gram + gram.T - np.diag(np.diag(gram))
    model["w"] = np.linalg.solve(gram + max(RIDGE * gram[0, 0], 1e-6) * np.eye(size), found[n:])

    def binned(pdf: pd.DataFrame) -> np.ndarray:
        at = np.minimum(((_raw(read(pdf), model) + 0.5) / 2 * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, pdf["y"].to_numpy(np.float64), minlength=BINS)])

    counted = partition_sums(rows.where("fold = 0"), binned, 2 * BINS)
    some = counted[:BINS] > 0
    if some.any():
        centres = (np.arange(BINS) + 0.5) / BINS * 2 - 0.5
        model["at"], model["to"] = isotonic(centres[some], counted[BINS:][some] / counted[:BINS][some], counted[:BINS][some])
    else:
        model["at"], model["to"] = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality(docs: DataFrame, labels: DataFrame, stash: Stash) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; ``labels`` (doc_id, y) may be learned from."""
    python_batches(docs.sparkSession)
    measured = stash.put("measured", docs.select("doc_id", "text").mapInArrow(_measure, "doc_id long, x array<double>"))
    rows = measured.join(labels.where("y IS NOT NULL"), "doc_id").select(F.pmod(F.xxhash64("doc_id"), F.lit(5)).alias("fold"), "x", "y")
    model = learn(stash.put("labelled", rows))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            value = shared.value
            if value:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, STATISTICS)
                score = np.clip(np.interp(_raw(x, value), value["at"], value["to"]), 0, 1).round(6)
            else:
                score = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id long, score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(id_mod("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("y"))
    found = quality(table(spark, sf_dir, "documents"), labels, Stash(spark))
    held = F.coalesce(id_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
