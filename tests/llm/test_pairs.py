"""Joins on sets, vectors and passages against brute force, with hard rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seamline.llm import components, jaccard, passages, vectors
from seamline.llm.common import Stash
from seamline.llm.shingles import mix64, run_hashes, shingle_set, word_hashes


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    """Chains of near copies, exact copies, a passage shared by all, short, blank and long texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(20)]
    rows, n = [], 0
    for _ in range(25):
        text = passage + [word() for _ in range(rng.randint(5, 120))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            rows.append((n, " ".join(text)))
            n += 1
            if rng.random() < 0.7:
                text = text[:]
                for _ in range(rng.randint(1, 4)):
                    text[rng.randrange(len(text))] = word()
    for t in (None, "", " \t\n", "one", "ONE", "one two", "one two", "\x1cone", "ÉCOLE", "école", "x " * 3000, "x " * 3001):
        rows.append((n, t))
        n += 1
    return rows


@pytest.mark.parametrize("light", [64, 2])
def test_jaccard_by_brute_force(spark, light, monkeypatch):
    """With long lists from three on nearly everything meets in blocks."""
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "OFTEN", 10)
    rows = corpus(light)
    docs = spark.createDataFrame([(d, t, "extra", 1) for d, t in rows], "doc_id long, text string, cid string, n int")
    got = sorted(map(tuple, jaccard.groups(docs, Stash(spark), 4, 85).collect()))
    assert got == brute(rows, 4, 85)


def test_jaccard_pairs_split_over_lists(spark):
    """Near copies that share two prefix shingles alone and two with a document of a smaller class id."""
    rng = random.Random(9)
    own = lambda n: [f"u{rng.randrange(10**12)}" for _ in range(n)]
    cid = lambda found: int(mix64(found + np.uint64(len(found))).sum(dtype=np.uint64).astype(np.int64))
    rows = []
    while len(rows) < 60:
        x = own(23)
        y = x[:-1] + own(1)
        runs, one, two = run_hashes(word_hashes(" ".join(x)), 4), shingle_set(" ".join(x), 4), shingle_set(" ".join(y), 4)
        if (one[:4] != two[:4]).any():
            continue
        at = [int(np.flatnonzero(runs == h)[0]) for h in one[:2]]
        for _ in range(200):
            z = " ".join(x[at[0] : at[0] + 4] + own(12) + x[at[1] : at[1] + 4])
            third = shingle_set(z, 4)
            if cid(third) < min(cid(one), cid(two)) and set(one[:2].tolist()) <= set(third[: len(third) - -(-len(third) * 85 // 100) + 1].tolist()):
                rows += [(len(rows) + i, t) for i, t in enumerate((" ".join(x), " ".join(y), z))]
                break
    got = sorted(map(tuple, jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string"), Stash(spark), 4, 85).collect()))
    assert got == brute(rows, 4, 85)


def test_jaccard_repeated_rows_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text), (5, text), (3, text), (None, "lone words here now"), (9, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.groups(docs, Stash(spark), 4, 85).collect()), key=repr)
    assert got == sorted([(5, 27, 3), (5, 27, 3), (3, 27, 3), (None, 1, None), (9, 0, 9)], key=repr)
    kept = jaccard.keep_one(docs, Stash(spark)).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == [3, 9, None]
    assert jaccard.keep_one(docs.unionByName(spark.createDataFrame([(9, ""), (9, " ")], "doc_id long, text string")), Stash(spark)).where("doc_id = 9").count() == 3
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.groups(none, Stash(spark), 4, 85).count() == 0


def test_jaccard_ids_with_several_texts(spark):
    """Each text of an id is compared and kept by itself; only linked rows are left out."""
    rng = random.Random(11)
    one, two, three = (" ".join(f"u{rng.randrange(10**9)}" for _ in range(40)) for _ in range(3))
    rows = [(5, one), (5, two), (3, two), (7, three), (7, one + " end"), (8, three + " end"), (5, one)]
    docs = spark.createDataFrame([(d, t, d) for d, t in rows], "doc_id long, text string, th long")
    got = sorted(map(tuple, jaccard.groups(docs, Stash(spark), 4, 85).collect()))
    assert got == sorted([(5, 37, 5), (5, 37, 3), (3, 37, 3), (7, 37, 7), (7, 38, 5), (8, 38, 7), (5, 37, 5)])
    kept = sorted((r["doc_id"], r["text"]) for r in jaccard.keep_one(docs, Stash(spark)).collect())
    assert kept == sorted([(5, one), (3, two), (7, three)])


def test_jaccard_classes_of_equal_sums(spark):
    """Classes that agree in the first sum only get numbers of their own."""
    heads = spark.createDataFrame([(1, 0, 9, 77, 1), (2, 1, 9, 77, 2), (3, 1, 9, 77, 2), (4, 2, 9, 78, 5)], "doc_id long, th long, n long, cid long, check long")
    heads, classes, moved = jaccard._classes(heads, Stash(spark))
    of = {r["doc_id"]: r["cid"] for r in heads.collect()}
    assert of[1] == 77 and of[2] == of[3] != 77 and of[4] == 78 and moved == {(77, 2): of[2]}
    assert sorted((r["rep"], r["size"]) for r in classes.collect()) == [(1, 1), (2, 2), (4, 1)]


def test_hashes_tell_words_apart():
    assert len(set(word_hashes("ab ba abc a b").tolist())) == 5
    assert (word_hashes("Ab É") == word_hashes("aB É")).all() and word_hashes("É")[0] != word_hashes("é")[0]
    assert len(shingle_set("a b c d a b c d", 4)) == 4 and len(run_hashes(word_hashes("a b"), 4)) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 201), (200, 202)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), Stash(spark), "t").collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long"), Stash(spark), "e").count() == 0


def vector_rows(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        base = rng.normal(size=(40, 16))
        for v in base:
            for _ in range(rng.integers(1, 6)):
                rows.append((v + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.35]), label))
    rows += [(base[0] * 3, 0)] * 3 + [(np.zeros(16), 0), (np.full(16, np.nan), 0), (np.array([1.0, 2.0]), 0), (np.array([2.0, 4.0]), 0)]
    return [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)] + [(900, None, 0), (901, [], 0), (902, [None] * 16, 0)]


def exact_links(rows):
    links = {r[0]: set() for r in rows}
    good = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    for a, x, p in good:
        for b, y, q in good:
            if a != b and p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a].add(b)
    return links


@pytest.mark.parametrize("block", [2048, 8])
def test_vectors_by_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "PER_LIST", 24)
    rows = vector_rows(block)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, m string")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, Stash(spark)).collect()}
    want = exact_links(rows)
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= len(x) for i, x in want.items())
    assert found >= 0.9 * sum(map(len, want.values()))
    for i, r in got.items():
        assert r["kept"] == (r["component_id"] == i) and r["component_id"] <= i


@pytest.mark.parametrize("lists", [1024, 16])
def test_vectors_recall_with_more_lists_than_probes(spark, lists, monkeypatch):
    """Near copies among 3,000 vectors in some 60 lists a label, of one and of two levels; rows that repeat a vec_id."""
    monkeypatch.setattr(vectors, "PER_LIST", 24)
    monkeypatch.setattr(vectors, "LISTS", lists)
    rng = np.random.default_rng(lists)
    rows = []
    for base in rng.normal(size=(1000, 24)):
        for _ in range(3):
            rows.append((len(rows), [float(x) for x in base + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.3])], ["a", "b"][len(rows) % 6 == 0]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, Stash(spark)).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)
    assert near.sum() > 2000
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * near.sum()
    assert all(got[i]["n_links"] <= n for i, n in enumerate(near.sum(1)))
    again = vectors.near_vectors(df.unionByName(df.limit(1)), Stash(spark)).where("vec_id = 0").collect()
    assert len(again) == 2 and again[0]["n_links"] == got[0]["n_links"] + 1


def test_the_table_discards_and_loses_nothing():
    """Codes leave few pairs to the rerank and all those that link; without the table every pair would be multiplied."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(200, 32)), 3, axis=0) + rng.normal(size=(600, 32)) * 0.1
    model = vectors.fit(x, 4)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    lists, codes, errors = vectors.encode(model, x)
    exact = unit @ unit.T >= 0.93
    kept = 0
    for here in range(4):
        home = np.flatnonzero(lists[:, 0] == here)
        left = vectors.survivors(model, here, unit, codes[home], errors[home], np.sqrt(2 - 2 * 0.93))
        kept += left.sum()
        links = vectors.rerank(unit, unit[home], left, 0.93)
        assert (links == exact[:, home]).all()
        assert not vectors.rerank(unit, unit[home], np.zeros_like(left), 0.93).any()
    assert exact.sum() <= kept < 0.1 * len(x) ** 2


def test_vectors_empty(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), Stash(spark)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], None)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, vectors.near_vectors(same, Stash(spark)).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_passages(spark):
    rng = random.Random(4)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    shared = own(70)
    fuzzy = shared[:30] + own(2) + shared[31:50] + shared[52:]
    rows = [(1, own(40) + shared + own(30)), (2, own(5) + shared), (3, fuzzy + own(60)), (4, own(200)), (5, shared[:35] + own(80)), (6, []), (7, shared + own(300))]
    docs = spark.createDataFrame([(i, " ".join(w), 0) for i, w in rows] + [(8, None, 0), (None, "x y z", 0)], "doc_id long, text string, pos int")
    got = passages.repeated_passages(docs, Stash(spark)).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 7}
    pair = next(r for r in got if r["doc_id"] == 2 and r["partner_id"] == 1)
    assert (pair["start_word"], pair["end_word"], pair["partner_start"], pair["partner_end"], pair["similarity"]) == (5, 75, 40, 110, 1.0)
    loose = [r for r in got if r["doc_id"] == 3]
    assert loose and all(0.8 <= r["similarity"] < 1 for r in loose)
    assert passages.repeated_passages(docs.where("false"), Stash(spark)).count() == 0


def test_passages_parted_by_own_words(spark):
    """Three repeats of 51 words in one chain that is not alike as a whole, with other or inserted words between."""
    rng = random.Random(7)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    one, two, three = own(51), own(51), own(51)
    rows = [(1, one + own(22) + two + own(22) + three), (2, one + own(22) + two + own(22) + three), (3, own(9) + one + two + three)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = passages.repeated_passages(docs, Stash(spark)).collect()
    covered = {(r["doc_id"], r["partner_id"], p) for r in got for p in range(r["start_word"], r["end_word"])}
    for i, words in rows[:2]:
        places = [p for p, w in enumerate(words) if w in {*one, *two, *three}]
        assert all((i, j, p) in covered for j in (1, 2, 3) if j != i for p in places)
    assert all(r["similarity"] >= 0.8 and r["end_word"] - r["start_word"] >= 50 for r in got)


def changed(words, alike, how, rng, own):
    """A copy whose similarity is ``alike`` or a little more: every n-th word or random ones changed, left out or doubled."""
    n = int(len(words) * (1 - alike) + 1e-9)
    at = {round(i * len(words) / n) for i in range(n)} if how == "even" else set(rng.sample(range(len(words)), n))
    out = []
    for i, w in enumerate(words):
        if i not in at or i in (0, len(words) - 1):
            out.append(w)
        elif how == "moved" and rng.random() < 0.5:
            continue
        elif how == "moved" and rng.random() < 0.5:
            out += [w, *own(1)]
        else:
            out += own(1)
    return out


@pytest.mark.parametrize("how", ["even", "random", "moved"])
def test_passages_recall(spark, how):
    """Pairs of documents that share a passage of 55 to 90 words, at every similarity from 0.8 on; none of the others does."""
    rng = random.Random(how)
    common = [f"c{i}" for i in range(40)]  # a third of all words are frequent ones
    own = lambda n: [rng.choice(common) if rng.random() < 0.35 else f"u{rng.random():.9f}" for _ in range(n)]
    rows, planted = [], {}
    for alike in (0.8, 0.82, 0.84, 0.86, 0.88, 0.9, 0.95, 1.0):
        for _ in range(30):
            passage = own(rng.randint(55, 90))
            i = len(rows)
            rows += [(i, " ".join(own(rng.randint(0, 80)) + passage + own(60))), (i + 1, " ".join(own(rng.randint(0, 80)) + changed(passage, alike, how, rng, own) + own(30)))]
            planted[i] = alike
    got = {(r["doc_id"], r["partner_id"]) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), Stash(spark)).collect()}
    for alike in sorted(set(planted.values())):
        pairs = [i for i, a in planted.items() if a == alike]
        assert sum((i, i + 1) in got and (i + 1, i) in got for i in pairs) >= 0.9 * len(pairs), alike
    assert all(a // 2 == b // 2 for a, b in got)


def test_passages_of_overlapping_holders(spark):
    """Two documents share all of a passage whose halves many others hold as well."""
    rng = random.Random(12)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    words = own(60)
    rows = [(i, own(40) + words[:36] + own(40)) for i in (1, 20, 21, 22)] + [(i, own(30) + words[25:] + own(30)) for i in (2, 31, 32, 33)] + [(10, own(20) + words + own(9)), (30, words + own(50))]
    got = passages.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), Stash(spark)).collect()
    assert {(r["doc_id"], r["partner_id"]) for r in got} == {(10, 30), (30, 10)}


@pytest.mark.parametrize("crowd", [8, 2])
def test_passages_in_crowds_and_repeated_ids(spark, crowd, monkeypatch):
    """A passage that all documents hold, long texts, repeated rows and an id with two texts."""
    monkeypatch.setattr(passages, "CROWD", crowd)
    monkeypatch.setattr(passages, "TOGETHER", 16)
    rng = random.Random(3)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    words = own(56)
    rows = [(i, " ".join(own(30) + words + own(30))) for i in range(60)] + [(70, " ".join(own(20000) + words + own(20000)))]
    rows += [(80, rows[0][1]), (80, rows[0][1]), (81, " ".join(own(90))), (81, " ".join(own(9) + words)), (82, " ".join(own(300)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), Stash(spark)).collect()
    assert {r["doc_id"] for r in got} == {*range(60), 70, 80, 81}
    for i in (5, 70):
        at = rows[60 if i == 70 else i][1].split().index(words[0])
        assert any(r["doc_id"] == i and r["start_word"] <= at and r["end_word"] >= at + 56 for r in got)
    assert len(got) < 10 * len(rows)


def test_passages_with_all_partners(spark):
    """Each of 24 texts holds a passage with words of its own in it: every two of them are partners."""
    rng = random.Random(21)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    words = own(80)
    rows = [(i, " ".join(own(20) + changed(words, 0.96, "random", rng, own) + own(20))) for i in range(24)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), Stash(spark)).collect()
    assert {(r["doc_id"], r["partner_id"]) for r in got} == {(i, j) for i in range(24) for j in range(24) if i != j}


def test_seeds_of_runs_of_one_word():
    """Few seeds, told from either end, so that runs of other lengths meet at both."""
    h, at, _ = passages.seeds("x y z " + "the " * 1000 + "u v w")
    assert len(h) < 300
    there = dict(zip(h.tolist(), at.tolist(), strict=True))
    h, at, _ = passages.seeds("a b c d " + "the " * 300 + "e f g h")
    here = dict(zip(h.tolist(), at.tolist(), strict=True))
    shifts = {there[k] - here[k] for k in there.keys() & here.keys()}
    assert {-1, 699} <= shifts


def test_passages_of_long_beside_short_runs():
    """Two runs beside each other, in one text longer than in the other: the passage lies where they touch."""
    words = np.array([[1] * 41 + [2] * 41, [1] * 74 + [2] * 74], object)
    x, y = (np.array(w, np.uint32) for w in words)
    told = [{int(h): int(p) for h, p in zip(*passages.seeds(" ".join(f"w{i}" for i in w.tolist()))[:2], strict=True)} for w in (x, y)]
    places = sorted((told[0][h], told[1][h]) for h in told[0].keys() & told[1].keys())
    found = passages.chains(*(np.array(c) for c in zip(*places, strict=True)))
    assert any((s, e, rs, re) == (0, 82, 33, 115) for c in found for s, e, rs, re, alike in passages.passages(x, y, *c) if alike == 1)


def test_passages_of_crowds_of_runs(spark, monkeypatch):
    """Runs of one word beside words of their own: only those of 50 words or more, or of enough words beside, connect."""
    def text(i, size):
        return " ".join([f"a{i}_{j}" for j in range(60)] + ["the"] * size + [f"b{i}_{j}" for j in range(60)])

    sizes = [28 + i % 12 for i in range(20)] + [50, 55, 60, 120]
    rows = [(i + 1, text(i, n)) for i, n in enumerate(sizes)]
    rows += [(31, text(31, 28) + " q" + " r s t u v w x y z k l m n o p" * 2), (32, "c d e f g " + text(32, 28).rsplit(" ", 60)[0] + " q" * 1 + " r s t u v w x y z k l m n o p" * 2)]
    rows.append((33, "the " * 30 + "q" + " r s t u v w x y z k l m n o p" * 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for crowd in (1000, 3):
        monkeypatch.setattr(passages, "CROWD", crowd)
        found[crowd] = {(r["doc_id"], r["component_id"]) for r in passages.repeated_passages(docs, Stash(spark)).collect()}
    assert found[3] == found[1000] == {*((i, 21) for i in (21, 22, 23, 24)), (32, 32), (33, 32)}
    some = spark.createDataFrame([(1, i + 1, 60) for i in range(20)], "seed long, doc_id long, pos int")
    none = spark.createDataFrame([], "node long, component long")
    assert passages._beside_unconnected(some, none, docs, Stash(spark)).count() < 190 / 4  # of 190 pairs


def test_passages_of_crowds_by_class(spark, monkeypatch):
    """One form of two lines in all texts, with the passages of six families around and between them: where hardly any
    two texts of a seed meet, the classes are those of all pairs."""
    rng = random.Random(22)
    own = lambda n: [f"u{rng.random():.12f}" for _ in range(n)]
    one, two = own(9), own(9)
    families = [(own(30), own(25), own(30)) for _ in range(6)]
    rows = []
    for i in range(54):
        a, b, c = families[i % 6] if i < 48 else (own(30), own(25), own(30))
        text = changed(a + one + b + two + c, 0.94, "random", rng, own) if i < 48 else a + one + b + two + c
        rows.append((i, " ".join(own(10) + text + own(10))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(passages, "CROWD", 1000)
    every = passages.repeated_passages(docs, Stash(spark)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in every} == {(i, i % 6) for i in range(48)}
    assert {(r["doc_id"], r["partner_id"]) for r in every} == {(i, j) for i in range(48) for j in range(48) if i != j and i % 6 == j % 6}
    monkeypatch.setattr(passages, "CROWD", 3)
    some = passages.repeated_passages(docs, Stash(spark)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in some} == {(i, i % 6) for i in range(48)}
    assert {(r["doc_id"], r["partner_id"]) for r in some} <= {(r["doc_id"], r["partner_id"]) for r in every}


def test_parts_of_an_alignment():
    rng = random.Random(8)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 25))] for _ in range(2))
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        at = passages.matched(x, y)
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, v in enumerate(a):
            for j, w in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if v == w else max(table[i][j + 1], table[i + 1][j])
        assert len(at) == table[-1][-1]
        assert all(a[i] == b[j] for i, j in at.tolist()) and (np.diff(at, axis=0) > 0).all()


def test_chains_by_brute_force():
    """The best chain's score equals the best over all increasing subsequences."""
    rng = random.Random(2)

    def best(points):
        score = []
        for i, (p, r) in enumerate(points):
            gains = [score[j] - passages.GAP * (p - a + r - b) for j, (a, b) in enumerate(points[:i]) if a < p and b < r]
            score.append(passages.K + max([0, *gains]))
        return max(score)

    def cover(points, chain):
        inside = [x for x in points if chain[0] <= x[0] <= chain[1] - passages.K and chain[2] <= x[1] <= chain[3] - passages.K]
        return best(inside)

    for _ in range(40):
        points = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(rng.randint(1, 15))})
        pos, rpos = np.array([p for p, _ in points]), np.array([r for _, r in points])
        assert cover(points, passages.chains(pos, rpos)[0]) == pytest.approx(best(points))


def test_common_words():
    x = np.array([1, 2, 3, 4, 5, 6], np.uint32)
    assert passages.common(x, x) == 6
    assert passages.common(x, np.array([1, 9, 2, 3, 5, 6], np.uint32)) == 5
    assert passages.common(x, x[:0]) == 0
    rng = random.Random(6)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 25))] for _ in range(2))
        table = [[0] * (len(b) + 1)]
        for v in a:
            row = [0]
            for j, w in enumerate(b):
                row.append(table[-1][j] + 1 if v == w else max(row[-1], table[-1][j + 1]))
            table.append(row)
        got = passages.common(np.array(a, np.uint32), np.array(b, np.uint32))
        straight = sum(v == w for v, w in zip(a, b, strict=False))
        assert got == (straight if len(a) == len(b) and straight >= 0.8 * len(a) else table[-1][-1])


def test_seeds_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, v, n)) for v, n in [(2000, 300), (3, 60), (40, 400), (2000, 30), (1, 90), (2000, 3), (9, 5)]] + ["", "é\udcff b", " a  b c d\te "]
    seed, pos, kind, number = passages.seeds_of(texts)
    for i, text in enumerate(texts):
        mine = zip(*(x[number == i].tolist() for x in (seed, pos, kind)), strict=True)
        assert sorted(mine) == sorted(zip(*(x.tolist() for x in passages.seeds(text)), strict=True))


def test_packed_rows_come_back_and_hot_seeds_are_parted():
    rng = np.random.default_rng(6)
    seed = np.where(rng.random(5000) < 0.8, 7, rng.integers(-(2**62), 2**62, 5000))
    rows = [seed, rng.integers(-(2**62), 2**62, 5000), rng.integers(0, 900, 5000), rng.integers(0, 70_000, 5000).astype(np.int32), rng.integers(0, 51, 5000)]
    for hot, least, most in [(np.array([], np.int64), 4000, 5000), (np.array([7]), 0, 500)]:
        packs = passages.Packs(passages._PAIRED, 1, 20, hot)
        packs.add([c[:2000] for c in rows])
        packs.add([c[2000:] for c in rows])
        bucket, packed = packs.packed()
        parts = [passages._unpacked(iter([pa.RecordBatch.from_arrays([packed.slice(i, 1)], names=["packed"])]), passages._PAIRED) for i in range(len(bucket))]
        assert least <= max(len(p[0]) for p in parts) <= most and len(set(bucket.to_pylist())) == len(bucket)
        assert sorted(zip(*(np.concatenate(c).tolist() for c in zip(*parts, strict=True)), strict=True)) == sorted(zip(*(c.tolist() for c in rows), strict=True))


def test_words_around_are_counted_by_bins_as_by_documents():
    rng = np.random.default_rng(8)
    n = 300
    counts = np.minimum(rng.poisson(0.18, (n, passages.BINS)) + (rng.random((n, passages.BINS)) < 0.02), passages.AGREE).astype(np.uint8)
    columns = [np.full(n, 1), np.repeat([0, 1], n // 2), np.arange(n) * 3, rng.integers(0, 40, n), np.full(n, 5), rng.random(n) < 0.5]
    names = ["seed", "part", "doc_id", "class", "most", "asks", "counts"]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([c.tobytes() for c in counts], pa.binary())], names=names)
    got = {x for b in passages._may_agree(iter([batch.slice(0, 70), batch.slice(70)])) for x in zip(b.column("doc_id").to_pylist(), b.column("ref").to_pylist(), strict=True)}
    _, part, doc, of, most, asks = columns
    want = {(doc[i], doc[j]) for i in np.flatnonzero(asks) for j in range(n) if part[i] == part[j] and of[i] != of[j] and (of[j] == 5 or doc[j] < doc[i]) and np.minimum(counts[i], counts[j]).sum() >= passages.AGREE}
    assert got == want and 0 < len(got) < asks.sum() * n / 4
