"""How the sources of a language differ in the terms they use.

Terms are runs of letters (ASCII letters and everything beyond ASCII), only A-Z lower-cased.
Counting packs them by length: a term of up to eight bytes is one uint64 word, of up to
sixteen two, zero bytes at the end. Words are sorted by radix (digits of sixteen bits, least
significant first) beside the number of their text and run-counted in numpy. Longer terms
go to one bucket for each length, where their bytes are sorted. Counts of a slice of texts
leave Python as rows (first word, second word, rest of the bytes), words flipped in the top
bit so that signed order is byte order; Spark adds the rows of all slices, pre-aggregated
before its shuffle, so a frequent term or source meets no task as more than one row from
each.

Each language keeps the terms in at least MIN_DOCS of its documents. Shares are smoothed
integers, all arithmetic is exact: divisions are of decimals or of 64-bit integers. For the
divergence of two sources every kept term becomes one row with the shares of all sources
of its language; numpy adds the terms of a task up to a matrix of sources by sources, and
only these sums are shuffled.

Null texts, languages and sources are ''. A (lang, source) without terms is a group like
any other; a language that keeps no term has values 0 and no ``term`` rows; a language with
one source has no ``pair`` rows. Every row is a document, repeated rows and null ids
included. Ties of value go by the bytes of the item. Long texts are counted in blocks. Only
``text``, ``lang`` and ``source`` are read, so extra columns may have any name. An empty
table gives no rows. Memory of a task grows with the square of the sources of one language, as the
result does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, materialize
from voxelark.llm.common import slices, stored, table

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
WORD = 8
#: Bytes of one long text counted at a time.
BLOCK = 1 << 20
#: Distinct terms a task gathers before it hands them on.
HELD = 1 << 17
#: Cells of the matrices a task gathers before it hands them on.
CELLS = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[ord("a") : ord("z") + 1] = True
_IN_TERM[128:] = True
_TOP_BIT = np.uint64(1 << 63)


def radix_order(*words: np.ndarray) -> np.ndarray:
    """Stable order by uint64 words, the first the most significant, sixteen bits at a time."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        spread = np.bitwise_or.reduce(word ^ word[0]) if len(word) else np.uint64(0)
        for shift in range(0, 64, 16):
            if (spread >> np.uint64(shift)) & np.uint64(0xFFFF):
                digit = (word[order] >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]
    return order


class Counts:
    """Terms of groups of texts: how often, and in how many texts. ``rest`` is b'' for packed terms."""

    def __init__(self, group, high, low, rest, n, docs):
        self.group, self.high, self.low, self.rest, self.n, self.docs = group, high, low, rest, n, docs

    def __len__(self):
        return len(self.group)


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _packed(raw: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """The first ``words`` words of the terms at ``start``, big-endian, zero beyond the term."""
    padded = np.concatenate([raw, np.zeros(words * WORD, np.uint8)])
    at = np.arange(words * WORD)
    cells = padded[start[:, None] + at]
    cells[at >= length[:, None]] = 0
    return [np.ascontiguousarray(cells[:, k * WORD : (k + 1) * WORD]).view(">u8")[:, 0].astype(np.uint64) for k in range(words)]


def count_terms(texts: list[bytes], groups: np.ndarray) -> list[Counts]:
    """Run-counted terms of some whole texts, a table for each bucket of lengths."""
    raw = _LOWER[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    inside = np.concatenate([[False], _IN_TERM[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, length = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, start, side="right").astype(np.uint64)
    found = []
    for low, high in ((0, WORD), (WORD, 2 * WORD)):
        mine = np.flatnonzero((length > low) & (length <= high))
        if len(mine):
            words = _packed(raw, start[mine], length[mine], high // WORD)
            found.append(_counted(words, text[mine], groups, None))
    for size in np.unique(length[length > 2 * WORD]).tolist():
        mine = np.flatnonzero(length == size)
        bodies = np.array([raw[s : s + size].tobytes() for s in start[mine].tolist()], dtype=f"S{size}")
        order = np.argsort(bodies, kind="stable")
        bodies, where = bodies[order], text[mine][order]
        new = _runs([bodies])
        number = np.cumsum(np.isin(np.arange(len(bodies)), new)) - 1
        words = _packed(raw, start[mine][order], length[mine][order], 2)
        rest = [b[2 * WORD :] for b in bodies[new].tolist()]
        found.append(_counted([number.astype(np.uint64)], where, groups, (words[0][new], words[1][new], rest)))
    return found


def _counted(words: list[np.ndarray], text: np.ndarray, groups: np.ndarray, long: tuple | None) -> Counts:
    """Counts by group and term; terms stand in order of text, which stable sorting keeps."""
    group = groups[text.astype(np.int64)].astype(np.uint64)
    order = radix_order(group, *words)
    words, group, text = [w[order] for w in words], group[order], text[order]
    new = _runs([group, *words])
    first_in_text = np.zeros(len(group), np.int64)
    first_in_text[_runs([group, *words, text])] = 1
    n = np.diff(np.concatenate([new, [len(group)]]))
    docs = np.add.reduceat(first_in_text, new)
    if long:
        number = words[0][new].astype(np.int64)
        rest = np.empty(len(new), object)
        rest[:] = [long[2][k] for k in number.tolist()]
        return Counts(group[new].astype(np.int64), long[0][number], long[1][number], rest, n, docs)
    low = words[1][new] if len(words) > 1 else np.zeros(len(new), np.uint64)
    return Counts(group[new].astype(np.int64), words[0][new], low, np.full(len(new), b"", object), n, docs)


def _added(parts: list[Counts]) -> Counts:
    """The sum of some counts; equal terms become one."""
    whole = Counts(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("group", "high", "low", "rest", "n", "docs")))
    has_rest = np.fromiter((bool(r) for r in whole.rest), bool, len(whole))
    # Numbers of the distinct rests stand for their bytes; 0 is no rest.
    rests = sorted(set(whole.rest[has_rest].tolist()))
    numbers = {r: k + 1 for k, r in enumerate(rests)}
    number = np.zeros(len(whole), np.uint64)
    number[has_rest] = [numbers[r] for r in whole.rest[has_rest].tolist()]
    keys = [whole.group.astype(np.uint64), whole.high, whole.low, number]
    order = radix_order(*keys)
    new = _runs([k[order] for k in keys])
    at = order[new]
    sums = (np.add.reduceat(x[order], new) for x in (whole.n, whole.docs))
    return Counts(whole.group[at], whole.high[at], whole.low[at], whole.rest[at], *sums)


def _blocks(text: bytes) -> Iterator[bytes]:
    """A long text in blocks that end outside of a term; a term longer than a block makes its block longer."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and _IN_TERM[_LOWER[text[end]]]:
            end += 1
        yield text[at:end]
        at = end


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, high, low, rest, n, docs) of all texts of a task."""
    names: dict[tuple[str, str], int] = {}
    held: list[Counts] = []

    def handed() -> Iterator[pa.RecordBatch]:
        if held:
            whole, langs, sources = _added(held), *(np.array([k[i] for k in names], object) for i in (0, 1))
            held.clear()
            for k in range(0, len(whole), 1 << 15):
                s = slice(k, k + (1 << 15))
                words = [pa.array((w[s] ^ _TOP_BIT).view(np.int64)) for w in (whole.high, whole.low)]
                group = whole.group[s]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(langs[group], pa.string()),
                        pa.array(sources[group], pa.string()),
                        *words,
                        pa.array(whole.rest[s], pa.binary()),
                        pa.array(whole.n[s].astype(np.int64)),
                        pa.array(whole.docs[s].astype(np.int64)),
                    ],
                    names=["lang", "source", "high", "low", "rest", "n", "docs"],
                )

    size = 0
    for batch in slices(batches):
        langs, sources, texts = (c.to_pylist() for c in batch.columns)
        group = np.array([names.setdefault(k, len(names)) for k in zip(langs, sources)], np.int64)
        raw = [t.encode() for t in texts]
        if len(raw) == 1 and len(raw[0]) > BLOCK:
            parts = [c for block in _blocks(raw[0]) for c in count_terms([block], group)]
            new = [_added(parts)] if parts else []
            for c in new:
                c.docs = np.ones(len(c), np.int64)
        else:
            new = count_terms(raw, group)
        held += new
        size += sum(map(len, new))
        if size > HELD:
            held[:] = [_added(held)]
            size = len(held[0])
            if size > HELD // 2:
                yield from handed()
                size = 0
    yield from handed()


TERM = ["high", "low", "rest"]


def term_text():
    """The term of a row (high, low, rest) as a string."""

    def plain(word):
        digits = F.hex(F.col(word).bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
        return F.regexp_replace(F.lpad(digits, 16, "0"), "(00)+$", "")

    return F.decode(F.concat(F.unhex(F.concat(plain("high"), plain("low"))), F.col("rest")), "UTF-8")


def share(count: str, n: str, v: str) -> str:
    """Smoothed integer share of a term as SQL: 1 + floor(SCALE * (count + 2) / (n + 2 * v))."""
    return f"(1 + (cast({SCALE} AS decimal(11,0)) * cast({count} + 2 AS decimal(19,0))) div cast({n} + 2 * {v} AS decimal(20,0)))"


def gap(p, q):
    """floor((p - q)^2 / (p + q)) of arrays of shares; squares of shares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, i, j, value) with i < j: gaps of the shares of two sources, added over the terms of a task."""
    sums: dict[str, np.ndarray] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, matrix in sums.items():
            i, j = np.triu_indices(len(matrix), 1)
            for k in range(0, len(i), 1 << 16):
                s = slice(k, k + (1 << 16))
                cells = [pa.array(x, pa.int64()) for x in (i[s], j[s], matrix[i[s], j[s]])]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i[s]), pa.string()), *cells], names=["lang", "i", "j", "value"])
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        ends = batch.column(1).offsets.to_numpy()
        flat = batch.column(1).values.to_numpy()
        for lang in sorted(set(langs.tolist())):
            rows = np.flatnonzero(langs == lang)
            n = ends[rows[0] + 1] - ends[rows[0]]
            matrix = sums.setdefault(lang, np.zeros((n, n), np.int64))
            step = max(1, CELLS // max(n, 1))
            for k in range(0, len(rows), step):
                p = flat[ends[rows[k : k + step]][:, None] + np.arange(n)]
                for i in range(n - 1):
                    matrix[i, i + 1 :] += gap(p[:, i : i + 1], p[:, i + 1 :]).sum(axis=0)
        if sum(m.size for m in sums.values()) > CELLS:
            yield from handed()
    yield from handed()


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of all pairs of sources, and the terms that mark a source."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shape = "lang string, source string, high long, low long, rest binary, n long, docs long"
    counted = rows.mapInArrow(_count_batches, shape).groupBy("lang", "source", *TERM)
    # One row for each kept term of a language, with its count in each source that has it.
    terms, _ = stored(
        counted.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", *TERM)
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by_source"))
        .filter(F.col("docs") >= min_docs),
        "terms",
    )
    per_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    single = terms.select("lang", F.explode("by_source").alias("s")).groupBy("lang", F.col("s.source").alias("source"))
    none = {"group_n": 0, "v": 0, "lang_n": 0}
    groups = rows.select("lang", "source").distinct().join(single.agg(F.sum("s.n").alias("group_n")), ["lang", "source"], "left")
    groups = materialize(groups.join(per_lang, "lang", "left").na.fill(none), "groups")
    numbered = groups.groupBy("lang", "v").agg(F.array_sort(F.collect_list(F.struct("source", "group_n"))).alias("sources"))
    numbered = materialize(numbered, "sources")

    counts = F.map_from_entries("by_source")
    known = attach(terms.select("lang", counts.alias("counts")), numbered, ["lang"], "inner", part_of=numbered)
    shares = "transform(sources, s -> " + share("coalesce(try_element_at(counts, s.source), 0)", "s.group_n", "v") + ")"
    equal = numbered.select("lang", F.transform("sources", lambda s: F.lit(1).cast("long")).alias("p"))
    sums = known.select("lang", F.expr(shares).alias("p")).union(equal).mapInArrow(_pair_sums, "lang string, i long, j long, value long")
    sums = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    both = sums.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.*", "value")
    names = materialize(numbered.select("lang", F.posexplode("sources")).select("lang", F.col("pos").cast("long").alias("a"), F.col("col.source").alias("source")), "names")
    both = attach(both, names, ["lang", "a"], "inner", part_of=names)
    both = attach(both, names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"], "inner", part_of=names)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    marks = terms.select("lang", *TERM, "total", F.explode("by_source").alias("s")).select("lang", *TERM, "total", "s.*")
    marks = attach(marks, groups, ["lang", "source"], "inner", part_of=groups)
    marks = marks.select(
        "lang", "source", *TERM, F.expr(share("n", "group_n", "v")).alias("p"), F.expr(share("total", "lang_n", "v")).alias("q")
    )
    marks = marks.filter("p > q").withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), *TERM)
    marks = marks.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    marks = marks.select("lang", "source", F.lit("term").alias("part"), term_text().alias("item"), "value", "rank")
    return pairs.union(marks)


def divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources and marking terms of all documents."""
    return audit(table(spark, sf_dir, "documents"))


QUERIES = {"op12_divergence": divergence_query}
ORACLES = {
    "op12_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), t AS (
  SELECT r, lang, source, translate(unnest(ts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}
), v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(gn.n, 0) + 2 * v.v) AS p,
         1 + {SCALE}::HUGEINT * (kept.n + 2) // (v.n + 2 * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN gn USING (lang, source)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), marks AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
  FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
  FROM marks
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
}
