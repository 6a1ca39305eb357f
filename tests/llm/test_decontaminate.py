"""Overlaps with benchmark items against a search of all stretches."""

import random

from voxelark.llm import decontaminate
from voxelark.llm.decontaminate import MIN_SHARE, MIN_WORDS


def brute(docs, items):
    """The best stretch of every pair of documents and items, from all stretches of all diagonals."""
    found = {}
    for d, doc in docs:
        for i, item in items:
            for shift in range(1 - len(item), len(doc)):
                lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
                equal = [doc[k + shift] == item[k] for k in range(lo, hi)]
                if sum(equal) < MIN_WORDS:
                    continue
                for a in range(len(equal)):
                    n = 0
                    for b in range(a, len(equal)):
                        n += equal[b]
                        if n >= MIN_WORDS and n >= MIN_SHARE * (b - a + 1):
                            found[d, i] = max(found.get((d, i), (0, 0)), (n, a - b - 1))
    return {k: (-m, n) for k, (n, m) in found.items()}


def overlaps(spark, docs, items):
    frames = [
        spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string").repartition(2)
        for name, rows in (("doc_id", docs), ("item_id", items))
    ]
    return {(r.doc_id, r.item_id): (r.n_aligned, r.n_equal) for r in decontaminate.overlaps(*frames).collect()}


def inside(rng, words):
    return [f"n{rng.randint(0, 99)}" for _ in range(rng.randint(0, 6))] + words + [f"n{rng.randint(0, 99)}" for _ in range(rng.randint(0, 6))]


def test_changes_near_the_ends_and_a_rewritten_middle(spark):
    rng = random.Random(1)
    items, docs = [], []
    for length, changes in ((13, 1), (14, 1), (15, 2), (16, 2)):
        for first in range(0, length, 2):
            item = [f"w{len(items)}x{k}" for k in range(length)]
            places = {first, (first + 5) % length} if changes == 2 else {first}
            docs.append((len(items), inside(rng, ["other" if k in places else w for k, w in enumerate(item)])))
            items.append((len(items), item))
    long = [f"long{k}" for k in range(55)]
    items.append((900, long))
    docs.append((900, inside(rng, long[:20] + ["new"] * 15 + long[35:])))
    got = overlaps(spark, docs, items)
    assert got == brute(docs, items)
    assert got[900, 900] == (20, 20) and {(i, i) for i, item in items if len(item) in (13, 16)} <= set(got)


def unseen_score(masks):
    """Greatest n_equal - 4 * n_changed of stretches of any length with MIN_WORDS equal words that no mask hits; None if unbounded."""
    span = max(map(len, masks))
    marks = [int(mask, 2) for mask in masks]
    best = {(0, 0): 0}
    edge = set(best)
    for _ in range(400):
        new = set()
        for past, n in edge:
            for same in (0, 1):
                now = (past << 1 | same) & (1 << span) - 1
                if same and any(now & mark == mark for mark in marks):
                    continue
                score = best[past, n] + (1 if same else -4)
                state = (now, min(MIN_WORDS, n + same))
                if score > best.get(state, -60):
                    best[state] = score
                    new.add(state)
        edge = new
        if not edge:
            return max(score for (_, n), score in best.items() if n == MIN_WORDS)
    return None


def test_seeds_miss_no_overlap(spark):
    assert MIN_SHARE == 0.8 and unseen_score(decontaminate.SEEDS) < 0
    assert unseen_score(decontaminate.MASKS) is None
    rng = random.Random(2)
    items, docs = [], []
    for length in (12, 15, 16, 20, 30, 59):
        for kind in range(4):
            item = [f"w{len(items)}x{k}" for k in range(length)]
            places = set(range(kind + 1, length, 5)) if kind < 2 else set(rng.sample(range(length), length // 5))
            docs.append((len(items), inside(rng, ["other" if k in places else w for k, w in enumerate(item)])))
            items.append((len(items), item))
    want = brute(docs, items)
    assert len(want) >= 18 and overlaps(spark, docs, items) == want


def test_short_items_are_found_verbatim(spark):
    items = [(1, ["one"]), (2, "to be or not".split()), (3, "k l m n o p q r s t u".split()), (4, "not so".split()), (5, [])]
    docs = [
        (1, "he said to be or not to be or not".split()),
        (2, "to be or".split()),
        (3, "to be or something not".split()),
        (4, "k l m n o p q r s t u v one".split()),
        (5, "k l m n o p q r s t v".split()),
        (6, ["one"]),
        (7, ["one"] * 40),
    ]
    want = {(1, 2): (4, 4), (4, 3): (11, 11), (4, 1): (1, 1), (6, 1): (1, 1), (7, 1): (1, 1)}
    assert overlaps(spark, docs, items) == want
