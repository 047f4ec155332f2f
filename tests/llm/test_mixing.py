import hashlib
import re

from seamline.llm import mixing
from seamline.llm.common import Stash


def by_hand(rows):
    """Targets by capping again and again, as the contract words it."""
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * size[s] for s in capped)
        target = {s: 3.0 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            return size, target
        capped |= over


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, Stash(spark), ["doc_id", "source"]).collect()
    size, target = by_hand(rows)
    taken = {}
    assert len(got) == len(rows)
    for r in got:
        source = r["row"]["source"]
        assert r["source_size"] == size[source]
        assert abs(r["target"] - target[source]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) < 3 * mixing.PACKET
    assert sum(taken.values()) == sum(size.values())
    assert {(r["row"]["source"], r["row"]["doc_id"]): r["taken"] for r in got} == queued(rows) or len({r[0] for r in rows}) < len(rows)
    return docs, got


def queued(rows):
    """What each document gives when all packets are sorted by finish time and cut at the budget, one by one."""
    size, _ = by_hand(rows)
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    packets, taken = [], {(r[2], r[0]): 0 for r in rows}
    for rank, source in enumerate(order):
        flow = sorted((hashlib.md5(str(d).encode()).hexdigest(), d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows if s == source)
        done = 0
        for _ in range(3):
            for _, d, n in flow:
                for start in range(0, n, mixing.PACKET):
                    words = min(mixing.PACKET, n - start)
                    done += words
                    packets.append((done * 6 // (rank % 3 + 1), rank, words, (source, d)))
    left = sum(size.values())
    for _, _, words, who in sorted(packets, key=lambda p: p[:2]):
        taken[who] += min(words, left)
        left -= min(words, left)
    return taken


def test_targets_and_takings(spark):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 5}") for i in range(200)] + [(500, "x " * 3, "tiny"), (501, None, "none"), (502, " \t ", None), (503, "a b", None)]
    docs, got = check(spark, rows)
    again = {(r["row"]["doc_id"], r["taken"]) for r in mixing.mix(docs, Stash(spark), ["doc_id", "source"]).collect()}
    assert again == {(r["row"]["doc_id"], r["taken"]) for r in got}


def test_one_source_holds_most(spark):
    check(spark, [(i, "w " * 50, "big") for i in range(100)] + [(200 + i, "v w", f"z{i}") for i in range(7)])


def test_repeated_rows_and_empty(spark):
    check(spark, [(1, "a b c", "s")] * 4 + [(2, "a " * 9, "t")])
    docs = spark.createDataFrame([], "doc_id long, text string, source string, size long")
    assert mixing.mix(docs, Stash(spark), ["doc_id"]).count() == 0


def test_mixture_serves_whole_texts_and_cuts_the_last(spark):
    rows = [(i, " ".join(hashlib.md5(f"{i}-{j}".encode()).hexdigest() for j in range(i % 9 + 1)), f"s{i % 3}", "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mixture(docs, Stash(spark)).collect()
    _, target = by_hand([r[:3] for r in rows])
    words = {}
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        assert texts[r["doc_id"]].startswith(r["text"])
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    assert all(abs(words[s] - t) < 3 * mixing.PACKET for s, t in target.items())
    assert sum(words.values()) == sum(len(r[1].split()) for r in rows)


def test_the_packet_decides(spark, monkeypatch):
    """Other packets give another order and another cut, so the takings come from the order."""
    rows = [(i, "w " * (i * 97 % 900 + 1), f"s{i % 5}") for i in range(100)]
    _, one = check(spark, rows)
    monkeypatch.setattr(mixing, "PACKET", 64)
    _, two = check(spark, rows)
    assert sorted((r["row"]["doc_id"], r["taken"]) for r in one) != sorted((r["row"]["doc_id"], r["taken"]) for r in two)


def test_long_text_and_nameless_rows(spark):
    """A text of many packets, and rows without an id, which stay apart by their texts."""
    rows = [(1, "w " * 60000, "a"), (2, "v " * 100, "b"), (None, "u " * 40, "b"), (None, "t " * 50, "b"), (3, "", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (sorted(((r["row"]["doc_id"], r["size"], r["taken"]) for r in mixing.mix(docs, Stash(spark), ["doc_id"]).collect()), key=repr) for _ in range(2))
    assert one == two and sum(t for _, _, t in one) == 60190
