"""Every operator on empty tables, null ids and texts, repeated rows, long texts and clashing columns."""

import pytest

from voxelark.llm import (
    centroids,
    decontaminate,
    divergence,
    embeddings,
    html,
    language,
    minhash,
    pieces,
    quality,
    rollup,
    sharding,
    suffixes,
    superkmers,
)

tokenizers = pytest.importorskip("public_tokenizers")
LONG = " ".join(f"long{i % 9973}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
BODY = "The house stands by the river and nobody has lived there for many years, number"
ROWS = [
    (1, f"{BODY} one. {PASSAGE}", "en", "web"),
    (2, f"{BODY} two. {PASSAGE}", "en", "web"),
    (3, f"{BODY} two. {PASSAGE}", "en", None),
    (3, f"{BODY} two. {PASSAGE}", "en", None),
    (4, None, None, "web"),
    (5, "", "en", ""),
    (6, " \t\n", "de", "web"),
    (7, LONG, "en", "books"),
    (8, LONG + " end", None, "books"),
    (None, f"{BODY} one. {PASSAGE}", "en", "web"),
    (None, None, None, None),
]
SHAPE = "doc_id long, text string, lang string, source string"
# Names that operators use inside.
CLASHES = (
    "n rows row rep print signature words bucket anchor start packed lo hi copy spans __id __copy __spans lot cell shard slot band place "
    "component node a b at seed spots shift item_id n_item stratum size key own x y label times mark estimate n_tokens ids decoded raw lines "
    "prints judged kept rules high low rest docs total by_source rank value p q text_print score ambiguous n_shingles class_id"
).split()


def plain(spark, rows=ROWS):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def clashing(spark, rows=ROWS):
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["z"] * len(CLASHES)) for r in rows], f"{SHAPE}, {extra}").repartition(2)


def items(spark, rows=((0, f"{BODY} two."), (1, None), (2, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def encoded(docs):
    return pieces.digests(pieces.encode_texts(docs, tokenizers.path(pieces.MODEL)))


def counted(docs):
    return rollup.token_counts(docs, tokenizers.path(f"{rollup.TOKENIZER}.tiktoken"), tokenizers.PATTERN)


OPERATORS = {
    "token counts": lambda s, d: counted(d),
    "later copies": lambda s, d: rollup.later_copies(d),
    "near duplicates": lambda s, d: minhash.near_duplicates(d, 2),
    "shards": lambda s, d: sharding.interleave(d, 24),
    "language": lambda s, d: language.predict(d, language.fit(d)),
    "substrings": lambda s, d: superkmers.remove_repeated(d),
    "suffixes": lambda s, d: suffixes.remove_repeated(d),
    "pieces": lambda s, d: encoded(d),
    "contamination": lambda s, d: decontaminate.overlaps(d, items(s)),
    "divergence": lambda s, d: divergence.audit(d, 1),
    "quality": lambda s, d: quality.judge(d),
}
#: Operators that return one row per row.
ROW_WISE = ("token counts", "near duplicates", "shards", "language", "substrings", "suffixes", "pieces", "quality")


def collected(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(spark, name):
    run = OPERATORS[name]
    want = collected(run(spark, plain(spark)))
    assert collected(run(spark, clashing(spark))) == want
    if name in ROW_WISE:
        assert len(want) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(spark, name):
    run = OPERATORS[name]
    assert run(spark, plain(spark, [])).count() == 0
    only_nulls = run(spark, plain(spark, [(None, None, None, None), (1, None, None, None)])).count()
    assert only_nulls == (2 if name in ROW_WISE else 0)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_null_ids_and_texts_have_defined_results(spark):
    docs = plain(spark)
    near = minhash.near_duplicates(docs, 2).collect()
    assert all(r.kept and r.component_id is None for r in near if r.doc_id is None)
    assert {r.doc_id: r.component_id for r in near if r.doc_id} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7}
    said = language.predict(docs, language.fit(docs)).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in said if r.doc_id in (4, 5, 6))
    held = docs.select("doc_id", language.held_out().alias("h")).collect()
    assert all(r.h is False for r in held if r.doc_id is None)
    for rest in (superkmers.remove_repeated(docs), suffixes.remove_repeated(docs)):
        gone = {}
        for r in rest.collect():
            gone.setdefault(r.doc_id, set()).add(r.n_removed)
        # Repeated rows agree, rows without an id lose nothing, copies lose what is long enough.
        assert all(len(x) == 1 for x in gone.values()) and gone[None] == {0} and gone[4] == gone[5] == gone[6] == {0}
        assert gone[1] == {0} and min(gone[2]) >= 60 and min(gone[3]) > 60 and min(gone[8]) >= 60_000
    codes = by_id(encoded(docs))
    assert codes[4].n_tokens == codes[5].n_tokens == 0 and codes[7].n_tokens > 60_000
    shards = sharding.interleave(docs, 24).collect()
    assert {r.size for r in shards if r.doc_id == 4} == {8} and len({(r.shard, r.slot) for r in shards}) == len(ROWS)
    found = decontaminate.overlaps(docs, items(spark)).collect()
    assert {r.doc_id for r in found} == {1, 2, 3} and {r.item_id for r in found} == {0}
    kept = decontaminate.clean(docs, items(spark)).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {4, 5, 6, 7, 8, None}
    counts = by_id(counted(docs))
    assert counts[4].n_tokens == counts[5].n_tokens == 0 and counts[7].n_tokens > 60_000
    assert sorted(r.doc_id for r in rollup.later_copies(docs).distinct().collect()) == [3]


def test_items_without_a_document_and_documents_without_an_item(spark):
    assert decontaminate.overlaps(plain(spark), items(spark, ())).count() == 0
    assert decontaminate.clean(plain(spark), items(spark, ())).count() == len(ROWS)


def test_vectors_with_clashing_columns(spark):
    rows = [(1, [1.0] * 64, 0), (2, [1.0] * 64, 0), (None, [1.0] * 64, 0), (3, None, 0), (4, [1.0] * 64, None), (1, [1.0] * 64, 0)]
    names = ("rep", "times", "band", "key", "e", "l", "good", "q", "cluster", "distance", "norm", "dots", "x", "y")
    shape = "vec_id long, embedding array<float>, label int"
    bare = spark.createDataFrame(rows, shape)
    extra = spark.createDataFrame([(*r, *["z"] * len(names)) for r in rows], shape + ", " + ", ".join(f"`{n}` string" for n in names))
    for run in (embeddings.near_vectors, lambda v: centroids.cluster(v)[0]):
        assert collected(run(extra)) == collected(run(bare))
        assert run(bare.limit(0)).count() == 0
    links = embeddings.near_vectors(bare).collect()
    assert len(links) == len(rows) and all(r.kept and r.component_id is None and r.n_links == 0 for r in links if r.vec_id is None)
    assert {r.n_links for r in links if r.vec_id == 1} == {2}


def test_pages_with_clashing_columns(spark):
    page = f"<nav>Home</nav><article><p>{BODY} one.</p><p>{BODY} two.</p></article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, "u", None), (3, None, ""), (4, "u", f"<p>{LONG}</p>")]
    shape = "page_id long, url string, html string"
    bare = spark.createDataFrame(rows, shape)
    extra = spark.createDataFrame([(*r, "z", 1) for r in rows], shape + ", text string, n_chars int")
    assert collected(html.extract(extra)) == collected(html.extract(bare))
    got = [(r.page_id, r.text) for r in html.extract(bare).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, f"{BODY} one.\n\n{BODY} two.")] * 2 + [(None, f"{BODY} one.\n\n{BODY} two."), (2, ""), (3, ""), (4, LONG)], key=repr
    )
    assert html.extract(bare.limit(0)).count() == 0


def test_pipeline_stages_on_edges(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in ([], ROWS):
        left = spark.createDataFrame([(*r, len(r[1] or ""), "z") for r in rows], SHAPE + ", n_chars long, copy string")
        for name, stage in pipeline.STAGES:
            left = spark.createDataFrame(stage(spark, left, str(tmp_path)).collect(), stage(spark, left, str(tmp_path)).schema)
            if not rows:
                assert left.count() == 0
        if rows:
            # One of the group stays, and it holds the benchmark item; rows without an id are in no decision by id.
            assert {r.doc_id for r in left.collect()} == {7, None}
