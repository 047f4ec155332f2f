"""Embedding near-dedup with an inverted file of product-quantised residuals.

Unit vectors are put into the list of their nearest coarse centroid; their
residual is coded by one of 256 centroids in each of 8 subspaces. A query
visits its ``PROBES`` nearest lists and adds up its distances to their codes
from a table per subspace. Only what the table leaves is reranked, by the exact
cosine in double precision. As a code's own error is stored, the triangle
inequality tells which vectors the table may discard: only lists that are not
visited can lose a link.

Beyond ``LISTS`` lists there is a second level of centroids, of the residuals,
and a list is a pair of them, so that lists grow in number with the vectors and
not in length. Centroids are fitted on at most ``SAMPLE`` vectors; all vectors
are indexed. Equal vectors of a label are one class with a count. A list is cut
into blocks of at most about ``BLOCK`` vectors and so are its queries, so one
hot list is spread over tasks; a block returns counts and a spanning forest,
never pairs.

Defined cases: null labels, null, empty or zero vectors and vectors with null
or non-finite components link with nothing; vectors of different lengths do
not link (those of other than the commonest length are compared exactly, in a
list of their own); equal rows link; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.common import Stash, python_batches, table
from seamline.llm.components import components, link_labels

SAMPLE, PER_LIST, LISTS, PROBES = 16_384, 256, 1024, 8
SUBSPACES, CODES, BLOCK, TURNS = 8, 256, 2048, 8


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's centroids; an empty cluster keeps its place."""
    k = max(1, min(k, len(x)))
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(TURNS):
        near = nearest(x, centres, 1)[:, 0]
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)[:, None]
        centres = np.where(count > 0, total / np.maximum(count, 1), centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` nearest centres, nearest first."""
    out = []
    for part in np.array_split(x, len(x) // 4096 + 1):
        d = (centres**2).sum(1)[None, :] - 2 * part @ centres.T
        out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
    return np.concatenate(out)


def fit(vectors: np.ndarray, lists: int) -> dict:
    """Coarse centroids of one or two levels and the codebooks of the residuals' subspaces."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    coarse = kmeans(unit, min(lists, LISTS), 1)
    rest = unit - coarse[nearest(unit, coarse, 1)[:, 0]]
    fine = kmeans(rest, min(-(-lists // LISTS), LISTS), 1) if lists > LISTS else np.zeros((1, unit.shape[1]))
    rest = rest - fine[nearest(rest, fine, 1)[:, 0]]
    cuts = np.array_split(np.arange(unit.shape[1]), min(SUBSPACES, unit.shape[1]))
    return {"dim": unit.shape[1], "coarse": coarse, "fine": fine, "cuts": cuts, "books": [kmeans(rest[:, c], CODES, 2 + i) for i, c in enumerate(cuts)]}


def centre(model: dict, lists) -> np.ndarray:
    """The centres of lists, numbered coarse by fine centroid."""
    lists = np.asarray(lists)
    return model["coarse"][lists // len(model["fine"])] + model["fine"][lists % len(model["fine"])]


def visited(model: dict, unit: np.ndarray) -> np.ndarray:
    """The ``PROBES`` nearest lists of each vector, nearest first."""
    first = nearest(unit, model["coarse"], PROBES)
    if len(model["fine"]) == 1:
        return first
    rows = np.arange(len(unit))[:, None]
    lists, far = [], []
    for turn in range(first.shape[1]):
        second = nearest(unit - model["coarse"][first[:, turn]], model["fine"], PROBES)
        number = first[:, [turn]] * len(model["fine"]) + second
        lists.append(number)
        far.append(((unit[:, None, :] - centre(model, number)) ** 2).sum(2))
    every = np.concatenate(lists, 1)
    return every[rows, np.argsort(np.concatenate(far, 1), axis=1, kind="stable")[:, :PROBES]]


def encode(model: dict, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists by nearness, codes in the nearest list and the errors of the codes."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    lists = visited(model, unit)
    rest = unit - centre(model, lists[:, 0])
    codes = np.stack([nearest(rest[:, c], b, 1)[:, 0] for c, b in zip(model["cuts"], model["books"], strict=True)], 1).astype(np.uint8)
    error = np.zeros(len(unit))
    for i, (c, b) in enumerate(zip(model["cuts"], model["books"], strict=True)):
        error += ((rest[:, c] - b[codes[:, i]]) ** 2).sum(1)
    return lists, codes, np.sqrt(error)


def _coder(model):
    schema = ["cid", "label", "m", "dim", "probes", "code", "err", "vec"]

    def run(batches):
        for pdf in batches:
            dims = pdf["embedding"].map(len).to_numpy()
            probes, codes, errors = [[-1]] * len(pdf), [b""] * len(pdf), np.zeros(len(pdf))
            value = model.value
            rows = np.flatnonzero(dims == value["dim"]) if value else []
            if len(rows):
                lists, code, error = encode(value, np.stack(pdf["embedding"].iloc[rows]).astype(np.float64))
                errors[rows] = error
                for i, r in enumerate(rows):
                    probes[r], codes[r] = lists[i].tolist(), code[i].tobytes()
            out = pdf[["cid", "label", "m"]].copy()
            out["dim"], out["probes"], out["code"], out["err"] = dims, probes, codes, errors
            out["vec"] = [np.asarray(v).tobytes() for v in pdf["embedding"]]  # as precise as the column
            yield out[schema]

    return run


def survivors(model: dict, here: int, query: np.ndarray, codes: np.ndarray, errors: np.ndarray, reach: float) -> np.ndarray:
    """Which codes of a list the asymmetric table leaves to each query: those that may lie within ``reach``."""
    rest = query - centre(model, here)
    far = np.zeros((len(query), len(codes)))
    for i, (c, book) in enumerate(zip(model["cuts"], model["books"], strict=True)):
        table_ = ((rest[:, c] ** 2).sum(1)[:, None] + (book**2).sum(1)[None, :]) - 2 * rest[:, c] @ book.T
        far += table_[:, codes[:, i]]
    return np.sqrt(np.maximum(far, 0)) <= reach + errors[None, :] + 1e-9


def rerank(query: np.ndarray, base: np.ndarray, left: np.ndarray, cosine: float) -> np.ndarray:
    """The pairs of ``left`` whose exact cosine is at least ``cosine``; no other pair is multiplied."""
    links = np.zeros(left.shape, bool)
    at, to = np.nonzero(left)
    for start in range(0, len(at), 1 << 14):
        i, j = at[start : start + (1 << 14)], to[start : start + (1 << 14)]
        links[i, j] = np.einsum("ij,ij->i", query[i], base[j]) >= cosine
    return links


def _compare(model, cosine: float, kind: str):
    reach = np.sqrt(2 - 2 * cosine)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"cid": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64")})
        base, query = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(base) or not len(query):
            return empty
        here = int(key[2])
        read = lambda part: np.stack([np.frombuffer(v, kind) for v in part["vec"]]).astype(np.float64)
        b, q = read(base), read(query)
        b, q = b / np.linalg.norm(b, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
        b_id, q_id = base["cid"].to_numpy(), query["cid"].to_numpy()
        q_home = np.array([p[0] for p in query["probes"]])
        twice = {h: np.array([h in p for p in base["probes"]]) for h in np.unique(q_home)}
        codes = np.stack([np.frombuffer(c, np.uint8) for c in base["code"]]) if here >= 0 else None
        links = np.zeros((len(q), len(b)), bool)
        for start in range(0, len(q), 64):
            part = slice(start, start + 64)
            # A pair whose two vectors visit each other's lists counts in one of them.
            mine = np.stack([np.where(twice[h], here < h, True) if h != here else q_id[i] < b_id for i, h in zip(range(start, len(q)), q_home[part], strict=False)])
            if here >= 0:
                mine &= survivors(model.value, here, q[part], codes, base["err"].to_numpy(), reach)
            links[part] = rerank(q[part], b, mine, cosine)
        if not links.any():
            return empty
        low, high = link_labels(links)
        names = np.concatenate([q_id, b_id])
        counts = np.concatenate([links @ base["m"].to_numpy(), links.T @ query["m"].to_numpy()])
        out = pd.DataFrame({"cid": names, "other": names[np.concatenate([low, high])], "links": counts})
        return out[out["links"] > 0]

    return run


def near_vectors(vectors: DataFrame, stash: Stash, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    python_batches(spark)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    keyed = vectors.select(
        "vec_id", "label", "embedding", F.when(F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)), F.xxhash64("label", "embedding")).alias("cid")
    )
    classes = stash.put(
        "vectors", keyed.where("cid IS NOT NULL").groupBy("cid", "label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    )
    stats = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    dims = classes.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    model = None
    if dims:
        sample = classes.where(F.size("embedding") == dims["dim"]).orderBy(F.xxhash64("cid")).limit(SAMPLE).select("embedding").toPandas()
        model = fit(np.stack(sample["embedding"]).astype(np.float64), max(1, stats // PER_LIST))
    shared = spark.sparkContext.broadcast(model)
    coded = stash.put(
        "coded",
        classes.select("cid", "label", "m", "embedding").mapInPandas(
            _coder(shared), f"cid long, label {classes.schema['label'].dataType.simpleString()}, m long, dim int, probes array<int>, code binary, err double, vec binary"
        ),
    )
    kind = {"float": "f4", "double": "f8"}[classes.schema["embedding"].dataType.elementType.simpleString()]
    cell = ["label", "dim", "list"]
    home = coded.withColumn("list", F.col("probes")[0])
    visits = coded.withColumn("list", F.explode("probes"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = home.groupBy(cell).agg(F.count("*").alias("bases")).join(visits.groupBy(cell).agg(F.count("*").alias("asks")), cell)
    sizes = stash.put("cells", sizes.select(*cell, blocks("bases").alias("nb"), blocks("asks").alias("nq")))
    columns = ["cid", "m", "probes", "code", "err", "vec"]
    part = lambda n: F.pmod(F.xxhash64(F.lit(7), "cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    bases = home.join(sizes, cell).select(*cell, part("nb").alias("bb"), every("nq").alias("qb"), F.lit(0).alias("side"), *columns)
    asks = visits.join(sizes, cell).select(*cell, every("nb").alias("bb"), part("nq").alias("qb"), F.lit(1).alias("side"), *columns)
    met = bases.unionByName(asks).groupBy(*cell, "bb", "qb").applyInPandas(_compare(shared, cosine, kind), "cid long, other long, links long")
    found = stash.put("links", met)
    degree = found.groupBy("cid").agg(F.sum("links").alias("others"))
    joined = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")), stash, "vcc")
    named = joined.join(classes, joined["node"] == classes["cid"]).select("cid", "component", "rep")
    groups = named.join(named.groupBy("component").agg(F.min("rep").alias("least")), "component").select("cid", "least")
    told = classes.select("cid", "rep", "m").join(degree, "cid", "left").join(groups, "cid", "left")
    told = told.select("cid", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("least", "rep").alias("first"))
    return keyed.join(told, "cid", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("first", "vec_id").cast("long").alias("component_id"),
        (F.coalesce("first", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), Stash(spark))
