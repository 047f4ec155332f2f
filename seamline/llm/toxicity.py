"""Toxicity scores of deobfuscated text by a noisy channel.

The source is a character model (four-grams with interpolation) counted over
the whole corpus. The channel may write a letter as a digit or sign, part the
letters of a word by blanks or marks, and repeat letters. A whole text is one
lattice of what its characters may stand for. Where the lattice has a path
through a word that the score knows, that stretch is decoded to the likeliest
letters by Viterbi search; elsewhere decoding cannot change the score. Such
stretches are found exactly: with characters that can stand for the same letter
made equal, parts left out and repeats made one, text and words are matched by
one automaton. A logistic regression over the words that mark labelled rows as
toxic, read from the restored text, gives the score, which is no lower than
what the surest of those words tells by itself: one such word in a long text
counts, though rows to learn from mostly hold several.

The regression learns from at most ``ROWS`` labelled rows, picked by a hash. It
uses every word of three letters or more that is ``TIMES`` as frequent in toxic
rows as overall, with a likelihood ratio of ``RATIO``; everything else covers
all rows.

Defined cases: null and empty texts have no words and get the base rate; labels
that are null, contradict each other or have no document are not learned from;
with no labels all scores are 0; equal rows get equal results; other columns
are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.llm.common import Stash, bounded, id_mod, python_batches, table

ROWS, LEAST, RATIO, TIMES, RIDGE = 20_000, 6, 10.0, 3.0, 0.1
#: Symbols of the character model: blank, a to z, other letters.
SYMBOLS = 28
#: Letters a digit or sign may stand for (fixed values).
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "¡": "i", "£": "l", "¢": "c", "(": "c"}
PARTS = " .-_*~·,'"
#: Costs in nats: a sign for a letter, a part between single letters left out or kept, a further repeat left out or kept, a sign left out.
SIGN, PART, BREAK, REPEAT, KEPT, LOST = 0.7, 0.2, 1.5, 0.2, 2.5, 4.0
_SPACED = re.compile(r"[^\W_](?:[ .\-_*~·][^\W_]){2,}")
_WORD = re.compile(r"[^\W\d_]{3,}")
_MARKS = re.compile("[̀-ͯ]+")
_codes: np.ndarray | None = None
_alike: np.ndarray | None = None


def _code_table() -> np.ndarray:
    global _codes
    if _codes is None:
        out = np.zeros(0x110000, np.int64)
        for i in range(0x30000):
            c = chr(i)
            if c.isalpha():
                base = unicodedata.normalize("NFKD", c)[0].lower()
                out[i] = ord(base) - 96 if "a" <= base <= "z" else 27
        _codes = out
    return _codes


def fold(text: str) -> str:
    """Lower case, without accents."""
    low = text.lower()
    return low if low.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", low.replace("ß", "ss")))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**4, np.int64)
    for batch in batches:
        codes = [np.zeros(1, np.int64)]
        for text in batch.column("text"):
            value = text.as_py()
            if value:
                codes += [_code_table()[np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)], np.zeros(1, np.int64)]
        c = np.concatenate(codes)
        c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]
        if len(c) > 3:
            total += np.bincount(((c[:-3] * SYMBOLS + c[1:-2]) * SYMBOLS + c[2:-1]) * SYMBOLS + c[3:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities (three symbols before, symbol): each order is mixed with the next shorter one by its number of followers."""
    found = docs.select("text").mapInArrow(_grams, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    count = np.zeros(SYMBOLS**4)
    count[found["k"]] = found["n"]
    count = count.reshape([SYMBOLS] * 4)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in (3, 2, 1, 0):
        seen = count.sum(axis=tuple(range(order)))
        total, kinds = seen.sum(-1, keepdims=True), (seen > 0).sum(-1, keepdims=True)
        p = (seen + kinds * p) / np.maximum(total + kinds, 1) + np.where(total + kinds == 0, p, 0)
    return np.log(np.maximum(p, 1e-12)).astype(np.float32)


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """What each character may stand for, with its cost; "" leaves it out."""
    single = bool(_SPACED.fullmatch(word)) or bool(re.fullmatch(r"(?:[^\s][.\-_*~·]){2,}[^\s]", word))
    steps: list[list[tuple[str, float]]] = []
    for run in re.finditer(r"(.)\1*", word, re.S):
        c, n = run.group(1), len(run.group())
        if c.isalpha():
            steps.append([(c, 0.0)])
            for _ in range(min(n, 3) - 1):
                steps.append([(c, 0.0), ("", REPEAT + 1)] if n == 2 else [(c, KEPT), ("", REPEAT)])
        elif c in SIGNS:
            steps.append([(x, SIGN) for x in SIGNS[c]] + [("", LOST)])
            for _ in range(min(n, 3) - 1):
                steps.append([(x, SIGN) for x in SIGNS[c]] + [("", REPEAT if n > 2 else SIGN)])
        elif c in PARTS:
            steps.append([("", PART), (" ", BREAK)] if single else [(" ", 0.3), ("", BREAK)])
        else:
            steps.append([("", SIGN)])
    return steps


class Decoder:
    """Viterbi search for the likeliest letters of a written word; words seen before are remembered."""

    def __init__(self, logs: np.ndarray):
        self.logs = logs
        self.words = lru_cache(1 << 15)(self._words)

    def _words(self, word: str) -> tuple[str, ...]:
        states = {(0, 0, 0): (0.0, "")}
        for options in [*lattice(word), [(" ", 0.0)]]:
            after: dict[tuple[int, int, int], tuple[float, str]] = {}
            for (a, b, c), (score, text) in states.items():
                row = self.logs[a, b, c]
                for letter, cost in options:
                    if not letter or (letter == " " and c == 0):
                        key, now = (a, b, c), (score - cost, text)
                    else:
                        code = 0 if letter == " " else _code(letter)
                        key, now = (b, c, code), (score - cost + float(row[code]), text + letter)
                    if key not in after or now[0] > after[key][0]:
                        after[key] = now
            states = after
        return tuple(max(states.values())[1].split())


def _alike_table() -> np.ndarray:
    """A number for every character that may be a letter, equal for those that may stand for the same; 0 for parts.

    Letters that share a sign are alike, and so are all letters but a to z.
    """
    global _alike
    if _alike is None:
        same = {chr(i): chr(i) for i in range(97, 123)}
        for letters in SIGNS.values():
            low = min(same[x] for x in letters)
            same = {k: low if v in {same[x] for x in letters} else v for k, v in same.items()}
        out = _code_table().copy()
        for i in range(1, 27):
            out[out == i] = ord(same[chr(96 + i)]) - 96
        for sign, letters in SIGNS.items():
            out[ord(sign)] = ord(same[letters[0]]) - 96
        _alike = out.astype(np.uint8)
    return _alike


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _skeleton(codes: np.ndarray) -> tuple[str, np.ndarray]:
    """Codes without parts and repeats as a string, and where each of its characters begins among the codes that are no parts."""
    solid = codes[codes > 0]
    begin = np.flatnonzero(np.concatenate([[True], solid[1:] != solid[:-1]])) if len(solid) else np.empty(0, np.int64)
    return (solid[begin] + np.uint8(96)).tobytes().decode("latin-1"), begin


class Finder:
    """The known words that a text holds, as they are or as the likeliest reading of something written over."""

    def __init__(self, lexicon: list[str], decoder: Decoder):
        self.decoder, self.index = decoder, {w: i for i, w in enumerate(lexicon)}
        by_skeleton: dict[str, set[str]] = {}
        for word in lexicon:
            by_skeleton.setdefault(_skeleton(_alike_table()[_chars(word)])[0], set()).add(word)
        self.automaton = ahocorasick.Automaton()
        for skeleton, words in by_skeleton.items():
            self.automaton.add_word(skeleton, (len(skeleton), words))
        if by_skeleton:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> tuple[list[int], int]:
        """Numbers of the words found, and how many words there are."""
        if not text:
            return [], 0
        plain = fold(text)
        chars = _chars(plain)
        letter = _code_table()[chars] > 0
        count = int((letter[1:] & ~letter[:-1]).sum()) + int(letter[0])
        if not self.index:
            return [], count
        codes = _alike_table()[chars]
        skeleton, begin = _skeleton(codes)
        if not skeleton:
            return [], count
        at = np.flatnonzero(codes)
        # A word begins behind what is no letter and ends before such; of a run of repeats, the ends that lie closest.
        opens = np.maximum.reduceat(np.where(np.concatenate([[True], ~letter[:-1]])[at], at, -1), begin)
        closes = np.minimum.reduceat(np.where(np.concatenate([~letter[1:], [True]])[at], at, len(plain)), begin)
        found: set[int] = set()
        for end, (size, words) in self.automaton.iter(skeleton):
            start, stop = int(opens[end - size + 1]), int(closes[end])
            if start < 0 or stop == len(plain) or stop < start:
                continue
            written = plain[start : stop + 1]
            read = (written,) if written in words else self.decoder.words(" ".join(written.split()))
            found.update(self.index[w] for w in read if w in self.index)
        return sorted(found), count


def design(found: tuple[list[int], int]) -> tuple[list[int], float, float]:
    """Presence of the known words, and how many there are, in all and of the words."""
    return found[0], float(np.log1p(len(found[0]))), 10 * len(found[0]) / max(found[1], 1)


def _table(rows: list[tuple[list[int], float, float]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, columns and values of a sparse table; the last three columns are the two counts and a constant."""
    sizes = [len(r[0]) for r in rows]
    n = np.arange(len(rows))
    own = np.concatenate([np.array(r[0], np.int64) for r in rows]) if rows else np.empty(0, np.int64)
    return (
        np.concatenate([np.repeat(n, sizes), n, n, n]),
        np.concatenate([own, np.full(len(n), width), np.full(len(n), width + 1), np.full(len(n), width + 2)]),
        np.concatenate([np.ones(len(own)), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.ones(len(n))]),
    )


def regression(rows: list[tuple[list[int], float, float]], y: np.ndarray, width: int) -> np.ndarray:
    """Weights by Newton's method; each step is solved by conjugate gradients on the sparse table."""
    at, to, value = _table(rows, width)
    size = width + 3
    times = lambda w: np.bincount(at, value * w[to], len(rows))
    back = lambda u: np.bincount(to, value * u[at], size)
    keep = np.append(np.full(size - 1, RIDGE), 1e-6)
    w = np.zeros(size)
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        curve = p * (1 - p)
        step, left = np.zeros(size), back(y - p) - keep * w
        scale = 1 / (np.bincount(to, value * value * curve[at], size) + keep)
        along = scale * left
        for _ in range(200):
            if np.abs(left).max() < 1e-8:
                break
            bent = back(curve * times(along)) + keep * along
            rate = (left @ (scale * left)) / (along @ bent)
            step, after = step + rate * along, left - rate * bent
            along = scale * after + (after @ (scale * after)) / (left @ (scale * left)) * along
            left = after
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"y": pdf["y"], "words": [sorted(set(_WORD.findall(fold(t)))) if t else [] for t in pdf["text"]]})


def _features(lexicon: list[str], logs) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(lexicon, Decoder(logs.value))
        for pdf in batches:
            rows = [design(finder.find(t)) for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"], "held": [r[0] for r in rows], "some": [r[1] for r in rows], "share": [r[2] for r in rows]})

    return run


def _fit(width: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, y = [], []
        for pdf in batches:
            rows += [(list(h), a, b) for h, a, b in zip(pdf["held"], pdf["some"], pdf["share"], strict=True)]
            y += pdf["y"].tolist()
        if rows:
            yield pd.DataFrame({"w": [regression(rows, np.array(y, float), width).tobytes()]})

    return run


def sure_share(a: np.ndarray, n: np.ndarray, tried: int) -> np.ndarray:
    """The lower bound (Wilson) of the share of toxic ones among ``n`` rows with ``a`` toxic ones, so wide that among all words that were tried not one is above it by chance."""
    z2 = 4 * np.log(max(tried, 2))
    p = a / n
    return (p + z2 / (2 * n) - np.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)


def learn(docs: DataFrame, labels: DataFrame, logs, stash: Stash) -> dict | None:
    """The lexicon and the regression, from (doc_id, y) of rows that may be learned from."""
    h = F.xxhash64(F.col("doc_id"), F.lit("toxic"))
    agreed = labels.where("y IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("high")).where("y = high")
    picked = stash.put("picked", agreed.select("doc_id", "y").orderBy(h, "doc_id").limit(ROWS))
    rows = stash.put("labelled", docs.select("doc_id", "text").join(bounded(picked, ROWS), "doc_id").select("text", "y"))
    totals = rows.groupBy("y").count().toPandas().set_index("y")["count"]
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not n1 + n0:
        return None
    words = rows.mapInPandas(_words, "y long, words array<string>")
    seen = words.select(F.explode("words").alias("word"), "y").groupBy("word").agg(F.sum("y").alias("a"), F.count("*").alias("n")).where(F.col("n") >= LEAST)
    a, b = F.col("a"), F.col("n") - F.col("a")
    expect = F.col("n") / F.lit(n1 + n0)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = 2 * (part(a, expect * n1) + part(b, expect * n0) + part(n1 - a, (1 - expect) * n1) + part(n0 - b, (1 - expect) * n0))
    seen = stash.put("seen", seen, small=True)
    # At most a word for every LEAST of the rows' words, which are bounded.
    marks = sorted((r["word"], r["a"], r["n"]) for r in seen.withColumn("ratio", ratio).where((a >= TIMES * expect * n1) & (F.col("ratio") >= RATIO)).select("word", "a", "n").collect())
    lexicon = [m[0] for m in marks]
    sure = sure_share(np.array([m[1] for m in marks], float), np.array([m[2] for m in marks], float), seen.count())
    told = rows.mapInPandas(_features(lexicon, logs), "y long, held array<long>, some double, share double")
    fitted = told.repartition(1).sortWithinPartitions("y", "held", "some", "share").mapInPandas(_fit(len(lexicon)), "w binary").collect()
    return {"lexicon": lexicon, "w": np.frombuffer(fitted[0]["w"]), "sure": sure} if fitted else None


def toxicity(docs: DataFrame, labels: DataFrame, stash: Stash) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; ``labels`` (doc_id, y) may be learned from."""
    python_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    logs = context.broadcast(character_model(docs))
    model = context.broadcast(learn(docs, labels, logs, stash))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = model.value
        finder = Finder(value["lexicon"], Decoder(logs.value)) if value else None
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if finder and batch.num_rows:
                rows = [design(finder.find(t.as_py())) for t in batch.column("text")]
                at, to, amount = _table(rows, len(value["lexicon"]))
                least = np.array([value["sure"][r[0]].max() if r[0] else 0.0 for r in rows])
                scores = np.maximum(1 / (1 + np.exp(-np.clip(np.bincount(at, amount * value["w"][to], batch.num_rows), -30, 30))), least).round(6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(id_mod("doc_id", 5) != 0).select("doc_id", F.col("toxic").cast("long").alias("y"))
    found = toxicity(table(spark, sf_dir, "documents"), labels, Stash(spark))
    held = F.coalesce(id_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
