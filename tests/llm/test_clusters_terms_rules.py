"""Centroid clustering, source divergence and quality rules against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voxelark.llm import centroids, divergence, quality


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


# ------------------------------------------------------------------ centroids


def brute_clusters(rows, k, rounds, dims):
    """Plain rounds with Python integers."""
    kept = [(i, [math.floor(64 * float(np.float32(v))) for v in x]) for i, x in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    centers = [q for _, q in named[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, q in kept:
            groups[nearest(q)[1]].append(q)
        centers = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if groups[n] else c for n, c in enumerate(centers)]
    return [(i, nearest(q)[1], nearest(q)[0]) for i, q in kept] if centers else [], centers


def vectors(seed, dims=8):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 2, (5, dims))
    rows = [(i, [float(v) for v in middles[i % 5] + rng.normal(0, 0.4, dims)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0] * (dims - 1)), (203, [None] + [1.0] * (dims - 1)), (204, [float("nan")] * dims)]
    rows += [(205, [float("inf")] * dims), (None, rows[3][1]), (300, rows[7][1]), (300, rows[7][1]), (301, [0.0] * dims), (302, [-0.0] * dims)]
    return rows


@pytest.mark.parametrize("k,rounds", [(16, 3), (4, 6), (200, 2)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    rows = vectors(k)
    want, centers = brute_clusters(rows, k, rounds, 8)
    extra = [(*r, "c", 9) for r in rows]
    state, got = centroids.cluster(frame(spark, extra, "vec_id long, embedding array<float>, cluster string, distance int"), k, rounds, 8)
    assert got.tolist() == centers
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in state.collect()), key=key) == sorted(want, key=key)


def test_stored_dot_products_stay_exact(spark):
    rows = vectors(3)
    state, centers = centroids.cluster(frame(spark, rows, "vec_id long, embedding array<float>"), 5, 3, 8)
    for r in state.collect():
        q = np.array(r.q, np.int64)
        assert list(r.dots) == (centers @ q).tolist() and r.norm == int(q @ q)


def test_clusters_of_nothing_and_of_huge_components(spark):
    shape = "vec_id long, embedding array<double>"
    for rows in ([], [(None, [1.0] * 8)], [(1, [1.0])]):
        state, centers = centroids.cluster(frame(spark, rows, shape), 4, 2, 8)
        assert state.count() == 0 and len(centers) == 0
    with pytest.raises(Exception, match="exact distances"):
        centroids.cluster(frame(spark, [(1, [1e9] * 8)], shape), 4, 2, 8)
    edge = (centroids.LIMIT - 1) / 64
    rows = [(i, [edge if i % 2 else -edge] * 64) for i in range(4)]
    state, _ = centroids.cluster(frame(spark, rows, shape), 1, 0)
    assert max(r.distance for r in state.collect()) == 64 * (2 * (centroids.LIMIT - 1)) ** 2


# ----------------------------------------------------------------- divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for _, text, lang, source in rows]
    seen, total, group = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        total[lang].update(terms)
        group[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        v = len(kept)

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        q = share(total[lang])
        p = {s: share(group[lang, s]) for s in {d[1] for d in docs if d[0] == lang}}
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            marks = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if group[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", marks, top)):
                out += [(lang, s, part, name, -value, k + 1) for k, (value, _, name) in enumerate(sorted(found)[:most])]
    return sorted(out)


def texts(seed):
    """Terms of all lengths, of several scripts, and of one letter, over unequal sources."""
    rng = random.Random(seed)
    words = ["a", "Abc", "ABCDEFGH", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "É", "é", "日本語", "naïve", "x" * 40, "x" * 41]
    words += ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    rows = []
    for i in range(300):
        source = rng.choice(["s0"] * 6 + ["s1", "s2", None, "", "S3", "日"])
        some = [rng.choice(words if source != "s1" else words[:9]) for _ in range(rng.randint(0, 40))]
        rows.append((i, rng.choice([" ", "1", "_", "-", "\x7f", "\n"]).join(some), rng.choice(["en", "en", None, "de"]), source))
    rows += [(900, None, "en", "s9"), (901, "", "fr", "s1"), (902, "1 2 !", "fr", "s2"), (903, "solo", "it", "s1"), (None, "a a a", "en", "s0")]
    rows += [(904, "a b " * 400_000 + "x" * 2_000_000, "en", "s1")]
    return rows + rows[:5]


@pytest.mark.parametrize("min_docs", [10, 1])
def test_divergence_equals_plain_python(spark, monkeypatch, min_docs):
    monkeypatch.setattr(divergence, "HELD", 200)
    monkeypatch.setattr(divergence, "CELLS", 30)
    rows = texts(min_docs)
    docs = frame(spark, [(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, item string, rank int")
    got = [tuple(r) for r in divergence.audit(docs, min_docs).collect()]
    assert sorted(got) == brute_audit(rows, min_docs, 10)


def test_divergence_of_nothing(spark):
    assert divergence.audit(frame(spark, [], "text string, lang string, source string")).count() == 0
    alone = frame(spark, [("word", "en", "only")] * 12, "text string, lang string, source string")
    assert divergence.audit(alone).count() == 0


def test_radix_order_is_stable():
    rng = np.random.default_rng(0)
    for words in (1, 2, 3):
        keys = [rng.integers(0, 5, 500).astype(np.uint64) << np.uint64(rng.integers(0, 60)) for _ in range(words)]
        assert (divergence.radix_order(*keys) == np.lexsort(keys[::-1])).all()


# -------------------------------------------------------------------- quality

SPACE = re.compile(r"[ \t-\r]+")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def brute_rule(line):
    words, chars = split(line.translate(UPPER)), sum(map(len, split(line)))
    if not chars:
        return None
    symbols = sum(c in quality.SYMBOLS for c in line) + sum(len(m) for m in re.findall(r"[!?]{2,}", line))
    if 100 * symbols > 10 * chars or not any(c.isalpha() or c.isnumeric() for c in line):
        return "punctuation"
    if len(words) >= 20 and not re.search(r"[.,;:!?…]", line):
        return "punctuation"
    alone = re.search(r"[ \t-\r][|»›>•·/][ \t-\r][^\n]*[ \t-\r][|»›>•·/][ \t-\r]", line)
    upper, letters = sum(c.isupper() for c in line), sum(c.isalpha() for c in line)
    if (len(words) <= 12 and alone) or all(w in quality.MENU for w in words) or (letters >= 10 and 100 * upper > 60 * letters):
        return "navigation"
    if len(words) <= 30 and any(p in line.translate(UPPER) for p in quality.PHRASES):
        return "boilerplate"
    return None


def brute_quality(text):
    words, lines = split(text), (text or "").split("\n")
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    filled = [x for x in lines if split(x)]
    rules = [brute_rule(x) for x in lines]
    removed = sum(len(w) for x, r in zip(lines, rules) if r for w in split(x))
    chars = sum(map(len, words))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": sum(c in quality.SYMBOLS for c in text or ""),
        "n_dup_lines": len(filled) - len(set(filled)),
        "n_repeat_words": len(repeated),
        "base_failed": failed,
        "kept": not failed and 100 * removed <= 50 * chars,
        "n_lines": len(filled),
        "n_removed_lines": sum(r is not None for r in rules),
        "removed_chars": removed,
        "rules": rules,
        "cleaned": None if text is None else "\n".join(x for x, r in zip(lines, rules) if r is None),
    }


def messy(seed):
    rng = random.Random(seed)
    words = ["word", "Ätna", "日本", "x1", "end.", "and,", "HOME", "Menu", "next", "|", ">", "/", "***", "what??", "Cookie", "é", "&", "$5"]
    lines = ["", " \t", "Home Menu Login", "ALL CAPS CAPTION HERE", "All rights reserved.", "a | b | c", "--- --- ---", "Read more about it here."]
    out = [None, "", "\n\n", " \x0b\x0c\r\n", "short", "word " * 50, "home " * 5000, "w" * 30_000, "a b c d e f g h " * 3, "\n".join(lines)]
    for _ in range(150):
        body = [rng.choice(lines) if rng.random() < 0.2 else rng.choice([" ", "  ", "\t"]).join(rng.choice(words) for _ in range(rng.randint(1, 30)))
                for _ in range(rng.randint(1, 12))]
        out.append("\n".join(body + body[: rng.randint(0, 2)]))
    out.append("\n".join(" ".join(rng.choice(words) for _ in range(200)) + "." for _ in range(100)))
    good = ["A sentence, " + " ".join(f"word{rng.randint(0, 999)}" for _ in range(12)) + "." for _ in range(20)]
    out.append("\n".join([*good, "Licensed under a license.", "Home Menu Login"]))
    return out


def test_quality_equals_plain_python(spark):
    found = [(i if i % 9 else None, t) for i, t in enumerate(messy(1))]
    rows = [(d, t, i, "x") for i, (d, t) in enumerate(found + found[5:8])]
    docs = frame(spark, rows, "doc_id long, text string, n_words int, words string")
    got = quality.judge(docs).collect()
    assert len(got) == len(rows)
    key = lambda r: repr(sorted(r.items(), key=lambda x: x[0]))
    want = [{"doc_id": d, **brute_quality(t)} for d, t, *_ in rows]
    assert sorted(map(key, (r.asDict() for r in got))) == sorted(map(key, want))
    assert sum(w["kept"] for w in want) > 0 and any(w["base_failed"] for w in want)
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_plan_has_no_shuffle_and_no_python(spark):
    plan = quality.quality_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_quality_keeps_labelled_good_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality_query(spark, sf_dir).join(marks, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 20]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
