"""Operators of the training-data package against brute force, round trips and planted cases."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelark.llm import decontaminate, embeddings, html, language, minhash, pieces, rollup, sharding, suffixes, superkmers, windows
from voxelark.llm.common import components


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def passages(seed):
    """Short texts that share passages, with nulls, empty, periodic, long and equal ones."""
    rng = random.Random(seed)
    words = ["a", "bb", "c", "d é", "日本", "e"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 60))) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "ab " * 60), (4, "x" * 400), (6, "long word " * 3000)]
    for d in range(5, 60):
        parts = [rng.choice([rng.choice(words), rng.choice(base), f"q{rng.randint(0, 9)}"]) for _ in range(rng.randint(0, 8))]
        rows.append((d * 3 + 7, " ".join(parts)))
    return rows + [(1000, rows[20][1]), (1001, rows[20][1])]


def brute_components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("hot", [2000, 3])
def test_substring_and_suffix_removal(spark, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT_ROWS", hot)
    rows = passages(hot)
    size = 12
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, d), d)
    got = {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in superkmers.remove_repeated(frame(spark, rows), size, 3).collect()}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        assert got[d] == (kept, len(w), sum(gone))
    size, seen = 20, set()
    extra = frame(spark, [(*r, "n") for r in rows], "doc_id long, text string, copy string")
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in suffixes.remove_repeated(extra, size, 8).collect()}
    whole = {r.doc_id: r.text for r in suffixes.cleaned(extra, size, 8).collect()}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                gone[i : i + size] = [True] * size
            seen.add(b[i : i + size])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        assert got[d] == (kept, sum(gone), runs)
        assert whole[d] == (None if t is None else kept.decode("utf-8", "ignore"))


@pytest.mark.parametrize("tile", [256, 4])
def test_minhash_links(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(tile)
    rows = [(0, None), (1, ""), (2, "a"), (3, "A"), (4, "b")]
    bases = [[f"w{rng.randint(0, 500)}" for _ in range(rng.randint(20, 60))] for _ in range(4)]
    for d in range(5, 150):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
        rows.append((d, " ".join(words)))
    sets = {d: minhash.shingles(t, 2) for d, t in rows}
    linked = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = brute_components(sets, linked)
    got = minhash.near_duplicates(frame(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_of_a_chain_and_nothing(spark):
    chain = list(range(40))
    random.Random(1).shuffle(chain)
    edges = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:])] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in chain if i}, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_sharding_keeps_mixture_and_counts(spark):
    rows = [(i, "t" * (i % 7) if i % 11 else None, "hot" if i % 3 else (f"s{i % 5}" if i % 2 else None)) for i in range(1000)]
    got = sharding.interleave(frame(spark, rows, "doc_id long, text string, source string"), 24).toPandas()
    counts = got.groupby("shard").size()
    assert len(got) == 1000 and set(counts.index) == set(range(24)) and counts.max() - counts.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    source = {r[0]: r[2] for r in rows}
    hot = got.assign(hot=[source[d] == "hot" for d in got.doc_id]).groupby("shard").hot.sum()
    # Each of k strata is within one row of its part of a stretch of fractional ranks, which holds k rows more or less.
    strata, share = len(set(source.values())), sum(s == "hot" for s in source.values()) / 1000
    assert (abs(hot - share * counts) <= 1 + strata * share).all()
    assert sharding.interleave(frame(spark, [], "doc_id long, text string, source string"), 24).count() == 0


def test_language_codes_and_accuracy(spark):
    code = language.codewords(4)
    assert code.shape == (4, 7) and min((a != b).sum() for a, b in itertools.combinations(code, 2)) == 4
    assert language.codewords(30).shape[0] == 30
    rng = random.Random(2)
    vocabulary = {"en": "the and of with that thing".split(), "de": "der und nicht schön über ein".split(), "es": "el año que señor con los".split()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) for _ in range(12)), lang) for i, lang in enumerate(list(vocabulary) * 60)]
    extra = [(900, None, "en"), (901, "12 !!", "en"), (902, "", None), (903, "the and of that", None)]
    docs = frame(spark, rows + extra, "doc_id long, text string, lang string")
    model = language.fit(docs.filter("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i % 4 == 2)
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    rows = [(0, None, 1), (1, [0.0] * 16, 1), (2, [float("nan")] * 16, 1), (3, [None] + [1.0] * 15, 1), (4, [1.0] * 16, None), (5, [], 1)]
    centers = rng.standard_normal((5, 16))
    for i in range(300):
        v = centers[i % 5] + rng.standard_normal(16) * rng.choice([0.05, 0.12, 0.3])
        rows.append((10 + i, [float(x) for x in v], int(i % 2)))
    rows += [(1000 + i, rows[20][1], rows[20][2]) for i in range(5)]
    good = {r[0]: r for r in rows if r[0] >= 10}
    unit = {i: np.array(r[1]) / np.linalg.norm(r[1]) for i, r in good.items()}
    linked = [(a, b) for a, b in itertools.combinations(good, 2) if good[a][2] == good[b][2] and unit[a] @ unit[b] >= 0.98]
    n = Counter(x for pair in linked for x in pair)
    want = brute_components([r[0] for r in rows], linked)
    for tile in (512, 7):
        embeddings.TILE = tile
        got = embeddings.near_vectors(frame(spark, rows, "vec_id long, embedding array<float>, label int")).collect()
        assert len(got) == len(rows)
        exact = {r.vec_id: (r.n_links, r.component_id) for r in got}
        assert exact == {i: (n[i], want[i]) for i in exact}
    embeddings.TILE = 512


def test_html_main_text(spark):
    page = (
        "<html><body><header><a href=1>Home</a></header><div id='cookie-notice'>We use cookies</div><main><article><header>"
        "<h1>T</h1></header><p>One &eacute; two<p>three <em>four</em>five<br>six<ul><li>item a</li></ul><aside>Related</aside>"
        "<form><label>Mail</label></form><script>var t='</p>'</script><!-- x --><section class=comments><p>I like it very much"
        "</section></article></main><div class=sidebar><p>side</div><footer>foot</footer>"
    )
    assert html.main_text(page) == "T\n\nOne é two\n\nthree fourfive six\n\nitem a"
    pages = frame(spark, [(1, "u", None), (2, None, ""), (3, "u", page), (4, "u", "<p"), (5, "u", "plain")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[1] == got[2] == got[4] == "" and got[3].startswith("T\n\n")


def test_minimum_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 8)
        c, b = ([float(rng.randint(0, 6)) for _ in range(n)] for _ in range(2))
        w = {(i, j): float(rng.randint(0, 4)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(side):
            return sum(b[i] if side[i] else c[i] for i in range(n)) + sum(x for (i, j), x in w.items() if side[i] != side[j])

        best = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert abs(cost(html.minimum_cut(c, b, w)) - best) < 1e-6


def test_pieces_equal_the_library(spark, monkeypatch):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = tokenizers.path(pieces.MODEL)
    monkeypatch.setattr(pieces, "TABLE_WORDS", 50)
    texts = [None, "", " ", "  two  spaces ", "a▁b▁", "tab\tline\nend", "Ａ é 日本 😀", "<s> </s><unk>", "x" * 5000, "word " * 4000, "a b", "a b"]
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in pieces.encode_texts(frame(spark, list(enumerate(texts))), path).collect()}
    done = {r.doc_id: r for r in pieces.digests(pieces.encode_texts(frame(spark, list(enumerate(texts))), path)).collect()}
    for i, t in enumerate(texts):
        ids = processor.encode(t or "")
        assert list(got[i].ids) == ids and got[i].decoded == processor.decode(ids)
        assert done[i].n_tokens == len(ids)
        assert done[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_decontamination_tolerates_substitutions(spark):
    rng = random.Random(5)
    item = [f"w{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.randint(0, 999)}" for _ in range(n)]
    changed = [w if i % 7 else "other" for i, w in enumerate(item)]
    docs = [(1, " ".join(noise(50) + item + noise(9))), (2, " ".join(noise(5) + changed).upper()), (3, " ".join(noise(80))), (4, None), (5, ""), (6, " ".join(item[:8] + noise(30))), (7, "w1, w2! " + " - ".join(item))]
    items = frame(spark, [(0, " ".join(item)), (1, None), (2, "short item")], "item_id long, text string")
    documents = frame(spark, [(*d, "z") for d in docs], "doc_id long, text string, words string")
    found = decontaminate.overlaps(documents, items).collect()
    assert {r.doc_id for r in found} == {1, 2, 7}
    assert {r.doc_id for r in decontaminate.clean(documents, items).collect()} == {3, 4, 5, 6}


def test_rollup_is_idempotent_and_exact(spark, tmp_path):
    counts = spark.createDataFrame([(1, "a", "en", 3), (2, "a", "en", 4), (3, None, None, 5)], "doc_id long, source string, lang string, n_tokens long")
    rolled = rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rolled.totals().count() == 0
    assert rolled.commit("one", rollup.inserts(counts)) and not rolled.commit("one", rollup.inserts(counts))
    assert rolled.commit("two", rollup.deletes(counts.filter("doc_id = 2")))
    revised = counts.filter("doc_id = 3").withColumn("more", F.lit(9))
    assert rolled.commit("three", rollup.revisions(revised, "n_tokens", rollup.TOKENIZER, "more", "v2"))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rolled.totals().collect()}
    assert got == {("a", "en", rollup.TOKENIZER): (1, 3), (None, None, "v2"): (1, 9)}


def test_pipeline_over_a_small_table(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left, seen = docs, []
    for name, stage in pipeline.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, sf_dir).toPandas(), docs.schema)
        assert left.columns == docs.columns
        seen.append(left.count())
    assert docs.count() >= seen[0] >= seen[1] >= seen[2] >= seen[3] > 0.5 * docs.count()
    leaked = {r.doc_id for r in decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert not leaked & {r.doc_id for r in left.select("doc_id").collect()}
    ids = {r.doc_id: r.n_tokens for r in pipeline.run(spark, sf_dir).collect()}
    assert set(ids) == {r.doc_id for r in left.select("doc_id").collect()}
    assert re.fullmatch(r"[a-z_]+", pipeline.STAGES[0][0])
