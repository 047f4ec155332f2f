"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters of a text, lower-cased, with blanks for everything else, are hashed in
runs of one to three characters. Document frequencies come from every row that
may be learned from. The model is trained by follow-the-regularised-leader
(per-coordinate steps, L1 and L2 penalties, so most weights of the features
seen are exactly zero) on a sample of at most about ``PER_LANGUAGE`` rows of a
language, each whole and as a piece of a few words. A fifth of the rows is held
back to fit the temperature that calibrates the scores, by pieces of one to
eight words: whole texts are so easy to tell that any temperature would do.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows of null language are not learned from; with no rows to learn from all
texts are ``und``; equal rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.common import id_mod, python_batches, table

BITS = 14
FEATURES = 1 << BITS
ORDERS = 3
PER_LANGUAGE = 1500
#: Step size, smoothing, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.25, 1e-4, 3
#: Words of a piece, and characters of a text that pieces are cut from.
PIECE, CUT_FROM = 8, 1 << 16
#: Characters hashed at a time, so that a long text needs no more memory than a short one.
CHUNK = 1 << 18
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None if there is no letter."""
    if not text:
        return None
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[chars]
    if not letter.any():
        return None
    chars = np.where(letter, chars, np.uint32(32))
    out = np.zeros(FEATURES, np.int64)
    shift = np.uint32(32 - BITS)
    for start in range(0, len(chars), CHUNK):
        part = chars[max(0, start - ORDERS + 1) : start + CHUNK]
        value = np.zeros(len(part), np.uint32)
        for n in range(ORDERS):
            value = value[: len(part) - n] * np.uint32(0x01000193) + part[n:] + np.uint32(n + 1)
            skip = max(0, min(start, ORDERS - 1) - n)
            out += np.bincount(value[skip:] * np.uint32(0x9E3779B1) >> shift, minlength=FEATURES)
    return out


def sparse(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Indices and unit-length TF-IDF values of a text."""
    found = counts(text)
    if found is None:
        return None
    at = np.flatnonzero(found)
    value = (1 + np.log(found[at])) * idf[at]
    length = np.sqrt((value**2).sum())
    return (at, value / length) if length > 0 else (at, value)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, l1: float) -> np.ndarray:
    """Weights (features, classes) of the multinomial model; the last feature row is the intercept."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        active = np.maximum(np.abs(zs) - l1, 0) * np.sign(zs)
        return -active / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for turn in range(PASSES):
        for i in np.random.default_rng(turn).permutation(len(rows)):
            at = np.append(rows[i][0], FEATURES)
            value = np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(value @ w)
            p[labels[i]] -= 1
            g = value[:, None] * p[None, :]
            square = n[at] + g * g
            z[at] += g - (np.sqrt(square) - np.sqrt(n[at])) / ALPHA * w
            n[at] = square
    return weights(np.arange(FEATURES + 1))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which held-back rows are likeliest, by golden section on its logarithm."""
    loss = lambda t: -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()
    low, high, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, rows = np.zeros(FEATURES + 1, np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            found = counts(text)
            if found is not None:
                total[:FEATURES] += found > 0
                total[FEATURES] += 1
        rows += len(pdf)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"k": at, "n": total[at]})


def piece(text: str, seed: int) -> str:
    """One to ``PIECE`` neighbouring words of a text, picked by a number."""
    words = text[:CUT_FROM].split()
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, PIECE + 1))
    start = int(rng.integers(0, max(1, len(words) - size + 1)))
    return " ".join(words[start : start + size])


def _loss(logits: np.ndarray, labels: np.ndarray, t: float) -> float:
    return float(-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean())


def _train(languages: list[str], idf: np.ndarray, l1: float) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Texts are read a batch at a time and only their features are held.
        rows, pieces = [], []
        for pdf in batches:
            for t, x, h in zip(pdf["text"], pdf["lang"], pdf["h"], strict=True):
                found, part = sparse(t, idf), sparse(piece(t, h), idf)
                if found is not None:
                    rows.append((h, languages.index(x), found))
                if part is not None:
                    pieces.append((h, languages.index(x), part))
        if not rows:
            return
        key = lambda r: (r[0], r[1], len(r[2][0]), float(r[2][1].sum()))
        rows, pieces = sorted(rows, key=key), sorted(pieces, key=key)
        held = [r for r in pieces if r[0] % 5 == 0] or pieces or rows
        learned = [r for r in [*rows, *pieces] if r[0] % 5] or rows
        w = ftrl([r[2] for r in learned], np.array([r[1] for r in learned]), len(languages), l1)
        logits = np.stack([r[2][1] @ w[r[2][0]] + w[-1] for r in held])
        labels = np.array([r[1] for r in held])
        t = temperature(logits, labels)
        seen = np.unique(np.concatenate([r[2][0] for r in learned]))
        yield pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "t": [t], "before": [_loss(logits, labels, 1.0)], "after": [_loss(logits, labels, t)], "zero": [float((w[seen] == 0).mean())]})

    return run


def tell(value: dict | None, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Languages and calibrated scores of texts."""
    names, scores = [], []
    for text in texts:
        row = sparse(text.as_py(), value["idf"]) if value else None
        if row is None:
            names.append("und")
            scores.append(0.0)
            continue
        p = softmax((row[1] @ value["w"][row[0]] + value["w"][-1]) / value["t"])
        names.append(value["languages"][int(p.argmax())])
        scores.append(round(float(p.max()), 6))
    return names, scores


def learn(labelled: DataFrame, l1: float = L1) -> dict | None:
    """The model from rows of (doc_id, text, lang), all of which may be learned from.

    It tells the temperature ``t``, the held-back loss ``before`` and ``after``
    it, and the share of weights of seen features that are ``zero``.
    """
    spark = labelled.sparkSession
    python_batches(spark)
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    found = labelled.select("text").mapInPandas(_frequencies, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(FEATURES + 1)
    df[found["k"]] = found["n"]
    idf = np.log((1 + df[FEATURES]) / (1 + df[:FEATURES])) + 1
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 40))
    share = F.element_at(F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, PER_LANGUAGE / n)))), F.col("lang"))
    sample = labelled.withColumn("h", h).where(F.col("h") < share * float(1 << 40)).select("text", "lang", "h")
    trained = sample.repartition(1).mapInPandas(_train(languages, idf, l1), "w binary, t double, before double, after double, zero double").collect()
    if not trained:
        return None
    w = np.frombuffer(trained[0]["w"], np.float32).reshape(FEATURES + 1, len(languages)).astype(np.float64)
    return {"languages": languages, "idf": idf, "w": w, **{k: trained[0][k] for k in ("t", "before", "after", "zero")}}


def identify(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = tell(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, lang_pred string, score double")


def of_known_language(docs: DataFrame, least: float = 0.35) -> DataFrame:
    """``docs`` without rows that are ``und`` or whose best language is hardly likelier than any; whole rows pass through the model.

    The bar is low on purpose: short and mixed texts of a known language stay.
    """
    model = learn(docs.where(id_mod("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = tell(shared.value, batch.column("text"))
            yield batch.filter(pa.array([n != "und" and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(id_mod("doc_id", 4) != 2))
    found = identify(docs.withColumn("held_out", F.coalesce(id_mod("doc_id", 4) == 2, F.lit(False))), model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")
