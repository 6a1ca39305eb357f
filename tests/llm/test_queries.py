"""Whole queries without checking SQL against plain Python on the smallest tables."""

import base64
import hashlib
import itertools
from collections import Counter, defaultdict

import pytest

from voxelark.llm import html, language, minhash, pieces, rollup
from voxelark.llm.decontaminate import MIN_SHARE, MIN_WORDS

SF = "/root/testdata/sf0.001"


def test_rollup_query(spark):
    tokenizers, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    with open(tokenizers.path(f"{rollup.TOKENIZER}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, seen = defaultdict(lambda: [0, 0]), set()
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        if r.text is None or r.text not in seen:
            seen.add(r.text)
            sums = want[r.source, r.lang, rollup.TOKENIZER]
            sums[0] += 1
            sums[1] += len(encoder.encode_ordinary(r.text or ""))
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in rollup.rollup_query(spark, SF).collect()}
    assert got == dict(want)


def cut_text(page):
    """Main text by trying all labels of a page's blocks; None for pages of many blocks."""
    found, made = html.blocks_of(page or "")
    if len(found) > 12:
        return None
    content, boilerplate = html.costs(found, made)
    joined = html.edges(found)

    def cost(side):
        own = sum(b if s else c for s, c, b in zip(side, content, boilerplate))
        return own + sum(w for (i, j), w in joined.items() if side[i] != side[j])

    # Of equal costs the one with the most content.
    best = min(itertools.product((True, False), repeat=len(found)), key=lambda side: (round(cost(side), 6), -sum(side)))
    return "\n\n".join(b.text for b, s in zip(found, best) if s)


def test_html_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html.html_query(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    tried = 0
    for r in rows:
        want = cut_text(pages[r.page_id].html)
        tried += want is not None
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == (html.main_text(pages[r.page_id].html) if want is None else want)
    assert tried > 0


def near_duplicates(texts):
    sets = {d: minhash.shingles(t, 5) for d, t in texts.items()}
    root = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
    return {d for d, r in root.items() if r != d}


def without_repeats(texts, size=100):
    seen, rest = set(), {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(b[i : i + size])
        text = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        if texts[d] is None or text.strip(" "):
            rest[d] = None if texts[d] is None else text
    return rest


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def contaminated(text, items, places):
    doc, shifts = words(text), Counter()
    for at, word in enumerate(doc):
        shifts.update((i, at - k) for i, k in places[word])
    for (i, shift), n in shifts.items():
        if n >= MIN_WORDS:
            equal = [0 <= k + shift < len(doc) and doc[k + shift] == w for k, w in enumerate(items[i])]
            for a, b in itertools.combinations(range(len(equal) + 1), 2):
                if sum(equal[a:b]) >= max(MIN_WORDS, MIN_SHARE * (b - a)):
                    return True
    return False


def test_pipeline_against_plain_python(spark):
    pipeline, tokenizers = pytest.importorskip("corpus_pipeline"), pytest.importorskip("public_tokenizers")
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = [len(texts)]
    # The classifier is learned; its decisions are tested on held-out rows.
    unsure = {r.doc_id for r in language.predict(docs, language.fit(docs)).filter("ambiguous").collect()}
    texts = {d: t for d, t in texts.items() if d not in unsure}
    left.append(len(texts))
    copies = near_duplicates(texts)
    texts = without_repeats({d: t for d, t in texts.items() if d not in copies})
    left += [left[-1] - len(copies), len(texts)]
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    places = defaultdict(list)
    for i, item in items.items():
        for k, word in enumerate(item):
            places[word].append((i, k))
    texts = {d: t for d, t in texts.items() if not contaminated(t, items, places)}
    left.append(len(texts))
    print("documents left after each stage:", left)
    processor = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path(pieces.MODEL))
    want = {}
    for d, t in texts.items():
        ids = processor.encode(t or "")
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    got = [(r.doc_id, (r.n_tokens, r.ids_sha256)) for r in pipeline.run(spark, SF).collect()]
    assert len(got) == len(want) and dict(got) == want
