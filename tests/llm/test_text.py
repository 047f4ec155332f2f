"""Operators on single texts, with hard rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seamline.llm import decontaminate, language, licences, pii, quality, toxicity
from seamline.llm.common import Stash

WORD13 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def contamination(docs, bench):
    items = [(i, re.findall(WORD13, lower(t))) for i, t in bench]
    out = []
    for d, t in docs:
        words = re.findall(WORD13, lower(t))
        hit, ids = set(), set()
        for i, item in items:
            size = min(13, len(item))
            for at in range(len(item) - size + 1) if item else ():
                window = item[at : at + size]
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == window:
                        hit |= set(range(p, p + size))
                        ids.add(str(i))
        out.append((d, len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out)


def test_contamination_by_brute_force(spark):
    run = " ".join(f"w{i}" for i in range(40))
    bench = [(1, run), (2, "Short item Here"), (10, "É x"), (3, None), (4, "..."), (5, "the the the"), (1, run), (7, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 q")]
    docs = [
        (1, f"Alpha, {run.upper()} omega"),
        (2, "...short, ITEM here! short item"),
        (3, "é x and É x"),
        (4, None),
        (5, ""),
        (6, "?!"),
        (7, " ".join(f"w{i}" for i in range(12))),
        (8, " ".join(f"w{i}" for i in range(5, 18)) + " z" * 300),
        (9, "the the the the the"),
        (11, " ".join(f"w{i}" for i in range(5, 18)) + " z" * 200),
        (12, "q " * 5000 + run),
        (13, "A1b2C3 short-item_here"),
    ]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, word int")
    b = spark.createDataFrame([(*x, 0) for x in bench], "item_id long, text string, count int")
    assert sorted(map(tuple, decontaminate.scored(d, b, Stash(spark)).collect())) == contamination(docs, bench)
    kept = {r["doc_id"] for r in decontaminate.clean(d.withColumnRenamed("word", "n_hit"), b, Stash(spark)).collect()}
    assert kept == {x[0] for x in contamination(docs, bench) if not x[5]}
    assert decontaminate.scored(d.where("false"), b, Stash(spark)).count() == 0
    assert {r["n_hit"] for r in decontaminate.scored(d, b.where("false"), Stash(spark)).collect()} == {0}


def test_rarest_shingle_and_bounds_decide(spark):
    """The prefix is the rarest shingle, and a window that would stick out of a document is never a candidate."""
    run = [f"w{i}" for i in range(13)]
    common = " ".join(run[:6])
    docs = [(i, f"x{i} {common}") for i in range(9)] + [(50, " ".join(["lead", *run, "end"])), (51, " ".join(run[8:]) + " tail"), (52, " ".join(run[6:12]))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(run))], "item_id long, text string")
    shingles, _ = decontaminate.windows(b, Stash(spark))
    seen = decontaminate.occurrences(d, shingles, Stash(spark))
    first = decontaminate.prefixes(shingles, seen)
    (row,) = first.collect()
    assert row["place"] >= 2  # the shingles at 0 and 1 are in ten documents
    met = decontaminate.candidates(seen, first).collect()
    assert [(r["k1"], r["start"]) for r in met] == [("50", 1)]
    without = seen.join(shingles.select("window", "size", "place", "shingle"), "shingle")
    assert without.count() > 25  # what all shingles would have joined
    assert decontaminate.verified(decontaminate.candidates(seen, first), shingles, seen).count() == 1


def test_long_items_and_ties(spark):
    """An item of 3,000 words, windows that repeat in it, items that share windows, and a document that holds them all."""
    words = [f"w{i * i % 997}" for i in range(3000)]
    bench = [(1, " ".join(words)), (2, " ".join(words[500:600])), (3, " ".join(words)), (None, " ".join(words[:20])), (4, "a a a a a a a a a a a a a a a")]
    docs = [(1, " ".join(words[700:900])), (2, "q " + " ".join(words[505:540]) + " z" * 900), (3, "a " * 14), (3, "a " * 14), (4, " ".join(words[:13]))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.scored(d, b, Stash(spark)).collect()))
    items = [(i, re.findall(WORD13, lower(t))) for i, t in bench]
    where = {}
    for i, item in items:
        for at in range(len(item) - 12):
            where.setdefault(tuple(item[at : at + 13]), set()).add(i)
    want = []
    for doc, text in docs:
        found = re.findall(WORD13, text)
        hits = [(p, where[tuple(found[p : p + 13])]) for p in range(len(found) - 12) if tuple(found[p : p + 13]) in where]
        hit = {q for p, _ in hits for q in range(p, p + 13)}
        ids = sorted({str(i) for _, s in hits for i in s if i is not None})
        want.append((doc, len(found), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(found)))
    assert got == sorted(want)


def test_contamination_keeps_repeated_and_nameless_rows(spark):
    d = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (None, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = sorted([(r["doc_id"], r["n_hit"]) for r in decontaminate.scored(d, b, Stash(spark)).collect()], key=repr)
    assert got == sorted([(1, 2), (1, 2), (1, 0), (None, 2)], key=repr)


# The base patterns of the contract.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, m):
    number = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 9 <= len(number) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(number))))
        return 13 <= len(number) <= 19 and total % 10 == 0
    return True


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def found_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.with_spans(docs).orderBy("doc_id").collect()
    return [[(k, x["s"], x["e"]) for k in pii.KINDS for x in r[f"__s_{k}"]] for r in rows]


def test_spans_by_hand(spark):
    texts = [
        None, "", "a@b.c_d@e.f x@y", "mail é@ü.de ab@cd.ef.", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.00255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "+1 (017) 555-7713 +44 20 7946 0958. +1--------", "😀 a@b.co 😀😀 10.0.0.1", "1" * 5000, "a" * 60000, "a@" * 3000, "9 " * 4000 + "+1 23456789", "a.b.c@" + "d." * 4000 + "e",
    ]
    assert found_spans(spark, texts) == [base_spans(t) for t in texts]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a1.@+- ()29é_", max_size=60), min_size=30, max_size=60))
def test_spans_by_random_texts(spark, texts):
    assert found_spans(spark, texts) == [base_spans(t) for t in texts]


def rows_with_names():
    told = [f"{w} {v} meets Zorbania at zed@mail.example while {v} waits {i}" for i, (w, v) in enumerate((f"p{chr(97 + i)}q", f"filler{chr(97 + i)}x") for i in range(6))]
    rows = [(i, t) for i, t in enumerate(told)] + [(50 + i, f"plain text number {i} about nothing while at meets waits") for i in range(60)]
    rows += [(200 + i, "copy of Unusual words by cop@mail.example here") for i in range(20)] + [(300 + i, f"lone{chr(97 + i)} words near one{i}@mail.example") for i in range(9)]
    often = [(400 + i, f"call Quentin now on +1 212 555 0100 about that") for i in range(8)] + [(450 + i, f"Quentin sat number {i}") for i in range(4)]
    return rows + often + [(500 + i, f"{'z' * 300} 10.0.0.9 {'y' * 300}") for i in range(3)] + [(600, None), (601, ""), (None, "zed@mail.example Zorbania")]


def told_terms(rows):
    """The disclosure of every term around an entity, from plain counts of documents."""
    import math

    term = re.compile(r"[^\W\d_]{3,}")
    holders, near, said, held = {}, {}, {}, {}
    for n, (_, text) in enumerate(rows):
        text = text or ""
        for w in set(term.findall(text.lower())):
            said.setdefault(w, set()).add(n)
        for kind, start, end in base_spans(text):
            m = text[start:end]
            entity = (kind, m.lower() if kind == "email" else m if kind == "ip" else re.sub("[^0-9]", "", m))
            holders.setdefault(entity, set()).add(n)
            held.setdefault(n, set()).add(entity)
            spans = [(x.start(), x.end(), x.group().lower()) for x in term.finditer(text)]
            before = [w for s, e, w in spans if e <= start and s >= max(0, start - pii.REACH) and (s > start - pii.REACH or start <= pii.REACH)][-5:]
            behind = [w for s, e, w in spans if s >= end and (e < end + pii.REACH or (e == end + pii.REACH == len(text)))][:5]
            for w in {*before, *behind}:
                near.setdefault((entity, w), set()).add(n)
    out = []
    for n, (doc, text) in enumerate(rows):
        base, text = base_spans(text), text or ""
        level = {}
        for (entity, w), docs in near.items():
            if entity in held.get(n, ()) and len(docs) >= pii.SUPPORT:
                ic = math.log(len(rows) / len(holders[entity]))
                level[w] = max(level.get(w, 0), math.log(len(rows) * len(docs) / (len(said[w]) * len(holders[entity]))) / ic)
        terms = []
        for m in term.finditer(text):
            if level.get(m.group().lower(), 0) >= pii.GENERALISE and not any(s < m.end() and e > m.start() for _, s, e in base):
                terms.append(("removed" if level[m.group().lower()] >= pii.REMOVE else "generalised", m.start(), m.end()))
        write = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        out.append((doc, *(sum(k == kind for k, _, _ in base) for kind in BASE), hashlib.sha256(write(base).encode()).hexdigest(), write([*base, *sorted(terms)])))
    return sorted(out, key=repr)


def test_query_by_brute_force(spark, tmp_path):
    """The whole query, its hash and its spans; terms of one document, or said elsewhere too, disclose nothing."""
    rows = rows_with_names()
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, near int").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, pii.op4_pii(spark, str(tmp_path)).collect()), key=repr)
    assert got == told_terms(rows)
    spans = {r[0]: r[-1] for r in got}
    assert "removed" in spans[0] and "removed" in spans[201] and "generalised" in spans[400] and "removed" not in spans[301]


def test_terms_that_reveal_an_entity(spark):
    docs = spark.createDataFrame(rows_with_names(), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, Stash(spark)).collect()}
    texts = dict(rows_with_names())
    assert all("Zorbania" not in out[i] and "zed@" not in out[i] and "[EMAIL]" in out[i] for i in range(6))
    assert all(out[50 + i] == texts[50 + i] for i in range(60))
    assert "Unusual" not in out[200] and out[300] == "lonea words near [EMAIL]" and "[NAME]" in out[400] and out[450] == texts[450]


def test_without_the_thresholds_nothing_is_a_term(spark, monkeypatch):
    monkeypatch.setattr(pii, "GENERALISE", 2.0)
    docs = spark.createDataFrame(rows_with_names(), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, Stash(spark)).collect()}
    assert out[200] == "copy of Unusual words by [EMAIL] here"


def test_sanitised_rows(spark):
    rows = [(1, "x +1 (017) 555-7713, 10.0.0.1 é a@b.co", "s", 3), (2, None, None, None), (None, "", "s", 0), (1, "x +1 (017) 555-7713, 10.0.0.1 é a@b.co", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k1 int").withColumn("row", F.lit(1))
    got = sorted(map(tuple, pii.sanitise(docs, Stash(spark)).collect()), key=repr)
    clean = "x [PHONE], [IP] é [EMAIL]"
    assert got == sorted([(1, clean, "s", 3, 1), (2, None, None, None, 1), (None, "", "s", 0, 1), (1, clean, "s", 3, 1)], key=repr)
    assert pii.sanitise(docs.where("false"), Stash(spark)).count() == 0


SAY = {"en": "the house and the garden of the town with this", "de": "das haus und der garten ist nicht für die", "fr": "la maison et le jardin avec des élèves où"}


def spoken(n=240):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(SAY)[i % 3]
        rows.append((i, " ".join(rng.choice(SAY[lang].split()) for _ in range(rng.randint(5, 40))), lang))
    return rows


def test_language(spark):
    hard = [(1000, None, "en"), (1001, "", "en"), (1002, "12 !?", "de"), (1003, "das haus", None), (None, "the garden", "en"), (1004, "haus " * 90000, "de"), (1005, "é", "fr")]
    docs = spark.createDataFrame([(*r, "x") for r in spoken() + hard], "doc_id long, text string, lang string, score string")
    model = language.learn(docs.where("doc_id % 4 <> 2").drop("score"))
    got = {r["doc_id"]: r for r in language.identify(docs.select("doc_id", "text"), model, ["doc_id"]).collect()}
    held = [(i, lang) for i, _, lang in spoken() if i % 4 == 2]
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "de", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert model["zero"] > 0.1 and model["after"] <= model["before"]
    kept = {r["doc_id"] for r in language.of_known_language(docs).collect()}
    assert {1000, 1001, 1002} & kept == set() and len(kept) >= 0.97 * len(spoken())
    assert language.learn(docs.where("false")) is None
    assert language.identify(docs.select("doc_id", "text"), None, ["doc_id"]).where("lang_pred <> 'und'").count() == 0


def test_penalty_and_temperature_decide(spark):
    """Without L1 fewer weights are zero; without the temperature the scores are other ones."""
    docs = spark.createDataFrame([r for r in spoken()], "doc_id long, text string, lang string")
    one, two = language.learn(docs), language.learn(docs, 0.0)
    assert two["zero"] < one["zero"]
    hard = spark.createDataFrame([(1, "des"), (2, "in der"), (3, "the le")], "doc_id long, text string")
    score = lambda m: [r["score"] for r in language.identify(hard, m, ["doc_id"]).orderBy("doc_id").collect()]
    assert score(one) != score({**one, "t": 1.0})


def test_language_query_by_hand(spark, tmp_path):
    """The query learns from no held-out row, and marks them; repeated rows get equal results."""
    import zlib

    rows = spoken() + [(3, spoken()[3][1], "xx"), (None, "the garden", "en"), (500, None, None)]
    spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = language.op1_language(spark, str(tmp_path)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    assert sorted([(r["doc_id"], r["held_out"]) for r in got], key=repr) == sorted([(i, held(i)) for i, _, _ in rows], key=repr)
    test = [(r["lang_pred"], lang) for r in got for i, _, lang in spoken() if r["doc_id"] == i and held(i)]
    assert sum(a == b for a, b in test) >= 0.95 * len(test) and len(test) > 30
    assert {r["lang_pred"] for r in got if r["doc_id"] == 500} == {"und"}
    assert got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(1000)) + " é"
    whole = language.counts(text)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert (language.counts(text) == whole).all()


def test_quality(spark):
    import random

    rng = random.Random(2)
    good = lambda: ". ".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(9)).capitalize() for _ in range(rng.randint(1, 9)))
    bad = [lambda: " | ".join(good().split()), lambda: good().upper().replace(" ", "!! "), lambda: "same line\n" * rng.randint(9, 40), lambda: good().replace(" ", "### ")]
    rows = [(i, good() if i % 3 else rng.choice(bad)(), int(i % 3 > 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(5000, None, "x"), (5001, "", "x"), (5002, "a " * 50000, "x"), (None, "b", "x")], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2] + [(1, None), (7777, 1)], "doc_id long, y int")
    got = quality.quality(docs, labels, Stash(spark)).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    held = [(i, y) for i, _, y in rows if i % 2 == 0]
    assert sum((score[i] >= 0.5) == bool(y) for i, y in held) >= 0.95 * len(held)
    assert len(got) == 904 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.quality(docs, labels.where("false"), Stash(spark)).collect()} == {0.5}
    assert quality.quality(docs.where("false"), labels, Stash(spark)).count() == 0


def test_isotonic_is_monotone():
    import numpy as np

    at, to = quality.isotonic(np.arange(5.0), np.array([0.1, 0.4, 0.2, 0.9, 0.8]), np.ones(5))
    assert (np.diff(to) >= 0).all() and to[1] == pytest.approx(0.3) and at[1] == 1.5


def toxic_rows():
    import random

    rng = random.Random(3)
    plain = "house garden water light paper stone river table window bread winter summer little green yellow music letter number people mother idle riot".split()
    rows = []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randint(4, 30))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_toxicity_of_written_over_words(spark):
    hidden = ["you iddiot", "sccum", "you id iot", "mo ron", "hi idiot ten", "such mooorrrooon", "a5 1.d.1.0.t", "(m-o-r-o-n)", "z" * 70 + " moron " + "z " * 70, "what an 1d10t you", "such an i d i o t there", "the m.o.r.o.n again", "you iiidiiiot", "$cum of the water", "m0r0n", "IDIOT!!", "idiöt"]
    fair = ["house garden 10 20", "river t a b l e", "", None, "b2b paper 4 you", "riot in the idle garden", "x" * 90000, "the id of water", "455 10 7", "i d like o tea", ". , " * 30000, "idio table"]
    extra = [(5000 + i, t) for i, t in enumerate(hidden)] + [(6000 + i, t) for i, t in enumerate(fair)] + [(None, "moron")]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in toxic_rows()] + [(i, t, "x") for i, t in extra], "doc_id long, text string, words string")
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_rows() if i % 5] + [(1, None), (9999, 1)], "doc_id long, y long")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels, Stash(spark)).collect()}
    assert len(got) == docs.count()
    assert [t for i, t in enumerate(hidden) if got[5000 + i] < 0.5] == []
    assert [t for i, t in enumerate(fair) if got[6000 + i] >= 0.5] == []
    held = [(i, y) for i, _, y in toxic_rows() if i % 5 == 0]
    assert all((got[i] >= 0.5) == bool(y) for i, y in held)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.where("false"), Stash(spark)).collect()} == {0.0}
    assert toxicity.toxicity(docs.where("false"), labels, Stash(spark)).count() == 0


def test_lattices_decide(spark, monkeypatch):
    """With words read as they are written, what is written over is not found."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in toxic_rows()] + [(5000, "what an 1d10t you"), (5001, "mo ron")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_rows()] + [(0, 0)], "doc_id long, y long")
    logs = toxicity.character_model(docs)
    finder = toxicity.Finder(["idiot", "moron", "scum"], toxicity.Decoder(logs))
    assert finder.find("what an 1d10t you")[0] == [0] and finder.find("mo ron")[0] == [1]
    monkeypatch.setattr(finder.decoder, "words", lambda word: (word,))
    assert finder.find("what an 1d10t you")[0] == [] and finder.find("mo ron")[0] == [] and finder.find("an idiot, a moron")[0] == [0, 1]
    assert labels.count() == 1201  # row 0 has labels 1 and 0 and is left out
    model = toxicity.learn(docs, labels, spark.sparkContext.broadcast(logs), Stash(spark))
    assert set(model["lexicon"]) == {"idiot", "moron", "scum"}


def test_one_sure_word_in_a_long_text(spark):
    """All toxic rows hold two words; a long text with one of them is toxic too, one with a word seen a few times is not."""
    rng, plain = random.Random(4), [f"w{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    plain = [w[1:] * 2 for w in plain]
    say = lambda n: [rng.choice(plain) for _ in range(n)]
    rows = [(i, " ".join(say(30) + (["idiot", "moron"] + ["seldom"] * (i < 32) if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(2000)]
    asked = [(5000 + i, " ".join([*say(300), w, *say(300)])) for i, w in enumerate(["idiot", "m.o.r.o.n", "1d10t", "seldom", "house"])]
    docs = spark.createDataFrame([r[:2] for r in rows] + asked, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y long")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels, Stash(spark)).collect()}
    assert [got[5000 + i] >= 0.5 for i in range(5)] == [True, True, True, False, False]


def test_every_path_through_a_known_word_is_decoded():
    """Written over at random, each word is handed to the decoder, whatever stands around it."""
    import random

    import numpy as np

    rng = random.Random(5)
    decoder = toxicity.Decoder(np.zeros([toxicity.SYMBOLS] * 4, np.float32))
    asked = []
    decoder.words = lambda word: asked.append(word) or ()
    finder = toxicity.Finder(["idiot", "worthless", "imbecile", "fou"], decoder)
    signs = {}
    for sign, letters in toxicity.SIGNS.items():
        for x in letters:
            signs.setdefault(x, []).append(sign)
    for _ in range(300):
        word = rng.choice(["idiot", "worthless", "imbecile", "fou"])
        written = "".join((rng.choice(signs[c]) if c in signs and rng.random() < 0.5 else c) * rng.choice([1, 1, 3]) + rng.choice(["", "", " ", ".", "-"]) for c in word).strip(" .-")
        asked.clear()
        found = finder.find(f"{rng.choice(['', 'tt ', 'so ', 'o, '])}{written}{rng.choice(['', ' tt', ', fine', '. s'])}")[0]
        assert found or any(written.startswith(a) or a in written or written in a for a in asked), written


def test_regression_by_closed_form():
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(sorted(set(rng.integers(0, 6, 2).tolist())), float(rng.random()), float(rng.random())) for _ in range(200)]
    y = np.array([float(0 in r[0]) for r in rows])
    w = toxicity.regression(rows, y, 6)
    x = np.zeros((200, 9))
    at, to, value = toxicity._table(rows, 6)
    x[at, to] = value
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (y - p) - np.append(np.full(8, toxicity.RIDGE), 1e-6) * w).max() < 1e-5


def test_licences(spark):
    rows = [
        (1, "Some words here.\nLicensed under the Apache License, Version 2.0."),
        (2, "Released under the MIT License. Then much more text follows on this line."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "His driving licence was taken away; the copyright office is closed."),
        (6, "Nothing of the kind."),
        (7, None),
        (8, ""),
        (9, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.\nReleased under the MIT License."),
    ] + [(100 + i, f"plain sentence number {i} of the corpus. Another one {i}.") for i in range(50)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, family string")
    got = {r["doc_id"]: r["families"] for r in licences.scanned(docs.select("doc_id", "text"), Stash(spark)).collect() if r["families"]}
    assert got == {1: "apache", 2: "mit", 3: "gpl", 4: "cc-by-nc", 9: "apache,mit"}


def test_licences_without_cue(spark):
    """Each template is found as a document, and so are statements without a word of CUES."""
    rows = [(i, t, f) for i, (f, t) in enumerate((f, t) for f, ts in licences.TEMPLATES.items() for t in ts)]
    rows += [(100, "Distributed under Apache 2.0.", "apache"), (101, "Released under MIT.", "mit")]
    rows += [(200 + i, f"plain sentence number {i} of the corpus. Another one {i}.", None) for i in range(50)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licences.scanned(docs, Stash(spark)).collect() if r["families"]}
    assert got == {i: f for i, _, f in rows if f}


HELD_OUT = [
    ("Licensed under the Apache Licence, v2.0", "apache"), ("This library is released under the Apache License 2.0.", "apache"),
    ("You may obtain a copy; licensed under the Apache License Version 2.0.", "apache"), ("This code is licensed under the MIT License", "mit"),
    ("It is released under the MIT license.", "mit"), ("Published and released under the MIT License by its authors.", "mit"),
    ("This program is licensed under the GNU General Public License v3.", "gpl"), ("You can redistribute it under the terms of the GNU General Public License.", "gpl"),
    ("Licensed under the GNU Lesser General Public License.", "lgpl"), ("Released under the 3-Clause BSD License.", "bsd"),
    ("Text licensed under CC BY-SA 4.0", "cc-by-sa"), ("All content is licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This article is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"), ("Copyright 1999, all rights reserved.", "proprietary"),
    ("Subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
]
HELD_OUT_OTHERS = [
    "The MIT License is older than the Apache License, says our blog post.", "Her fishing licence expired in May.", "What is the difference between the GPL and the BSD License?",
    "Copyright disputes over the song went on.", "The software was released in June.", "The general public license debate was on the radio.", "He was released under the bridge.",
    "All rights of way were reserved for the railway.", "Creative people love the commons of the town.", "This work is hard.", "A warranty card lay in the box.", "The Apache helicopter landed in the lake.",
]


def test_licences_precision_and_recall(spark):
    """Statements in other words than the templates', and sentences that only speak of licences."""
    rows = [(i, t) for i, (t, _) in enumerate(HELD_OUT)] + [(100 + i, t) for i, t in enumerate(HELD_OUT_OTHERS)]
    docs = spark.createDataFrame([*rows, *((200 + i, f"plain sentence number {i} of the corpus.") for i in range(50))], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licences.scanned(docs, Stash(spark)).collect()}
    right = sum(got[i] == f for i, (_, f) in enumerate(HELD_OUT))
    told = sum(bool(x) for x in got.values())
    print([(t, got[i]) for i, t in rows if got[i] != dict((t_, f) for t_, f in HELD_OUT).get(t, "")])
    assert right >= 0.8 * len(HELD_OUT) and right >= 0.9 * told


def test_licence_rows(spark):
    """Nameless and repeated rows, ids with several texts, very long texts and clashing columns."""
    rows = [(1, "Released under the MIT License."), (1, "Nothing here."), (None, "Released under the MIT License."), (2, "Released under the MIT License.\n" * 2)]
    rows += [(3, "Licensed under CC BY-NC 4.0."), (3, "Licensed under CC BY-NC 4.0."), (4, "w " * 100000 + "\nLicensed under CC BY-NC 4.0."), (5, "plain words here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, family string")
    got = sorted(((r["doc_id"], r["families"], r["statements"]) for r in licences.scanned(docs, Stash(spark)).collect()), key=repr)
    assert got == sorted([(1, "mit", 1), (1, "", 0), (None, "mit", 1), (2, "mit", 1), (3, "cc-by-nc", 1), (3, "cc-by-nc", 1), (4, "cc-by-nc", 1), (5, "", 0)], key=repr)
    assert licences.scanned(docs.where("false"), Stash(spark)).count() == 0


def test_calibration_decides(spark, monkeypatch):
    """With the least probability out of reach nothing is found."""
    docs = spark.createDataFrame([(1, "Released under the MIT License."), (2, "plain words here")], "doc_id long, text string")
    monkeypatch.setattr(licences, "LEAST", 1.0)
    monkeypatch.setattr(licences, "MOST", 1.0)
    assert {r["families"] for r in licences.scanned(docs, Stash(spark)).collect()} == {""}
