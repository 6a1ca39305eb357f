"""Benchmark passages in documents by spaced seeds, with DataFrame functions only.

Words are runs of letters and digits of the lower-cased text. A mask marks five
positions that count; at every position of a
text the counted words are hashed, one hash per mask. Equal hashes of a document
and a benchmark item are a hit on a diagonal (document position minus item
position). Different masks ignore different places, so a passage is met although
some of its words were replaced. No overlap is missed: every stretch with MIN_WORDS and
MIN_SHARE, of whatever length, has five equal words in a row or the pattern of the
second mask. On a diagonal with a hit all aligned words of document
and item are compared: any stretch of them is an overlap when at least MIN_WORDS of its
words are equal and at least MIN_SHARE of them are. The stretch with the most equal
words is kept, the shortest of these.

The positions of documents are never shuffled while the hashes of the benchmark fit
the measured broadcast bound: the join is part of the scan's stage and only hits
leave it. A larger benchmark takes a shuffle join of hashes.

Items of fewer than MIN_WORDS words overlap where all their words stand in a document in
order; each length that occurs is one more seed. Null and empty texts have no overlap.
Documents and items are known by their ids: repeated rows of an id are one document, whose best
stretch with an item is kept; rows without an id are in no result and stay when cleaning. Of
equally good stretches the shortest counts. Empty tables give no rows, texts may have any length, and
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, fits_broadcast, materialize
from voxelark.llm.common import table

#: Every overlap is hit by one of these; to be checked again (tests) if MIN_WORDS or MIN_SHARE change.
SEEDS = ("11111", "110111")
#: Spaced seeds that miss overlaps of any length, so not used: the tests hold SEEDS against them.
MASKS = ("110111011011", "101101110111", "111101101101")
MIN_WORDS = 12
MIN_SHARE = 0.8


def words_of(text):
    """Words of a text column; none for null or blank texts."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(F.length(plain) > 0, F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def seeds(rows: DataFrame, lengths: list[int], whole: bool) -> DataFrame:
    """Add ``at`` and ``seed`` to rows with an array ``words``: one row per position and mask.

    ``lengths`` are those of short items, which have one seed of all their words. With
    ``whole`` the rows are items themselves, else texts that may hold them anywhere.
    """
    words, at, n = F.col("words"), F.col("at"), F.size("words")
    masks = [(mask, n >= MIN_WORDS) for mask in SEEDS]
    masks += [("1" * length, n == length if whole else n >= length) for length in lengths]
    last = n - min(len(mask) for mask, _ in masks)
    starts = rows.filter(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    hashes = [
        F.when(
            fits & (at + len(mask) <= n),
            F.xxhash64(F.lit(k), *[F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]),
        )
        for k, (mask, fits) in enumerate(masks)
    ]
    return starts.select("*", F.explode(F.array(*hashes)).alias("seed")).filter("seed is not null")


def best_stretch(equal):
    """(n_equal, minus n_aligned) of the best overlap in an array of booleans; null without one.

    A best stretch starts and ends with runs of equal words, so only pairs of runs are tried.
    """
    changed = F.concat(
        F.array(F.lit(-1)),
        F.filter(F.sequence(F.lit(0), F.size(equal) - 1), lambda k: ~F.get(equal, k)),
        F.array(F.size(equal)),
    )
    gaps = F.transform(
        F.slice(changed, 2, F.size(changed) - 1),
        lambda end, i: F.struct(i.alias("i"), (F.get(changed, i) + 1).alias("lo"), end.alias("hi")),
    )
    runs = F.filter(gaps, lambda r: r["hi"] > r["lo"])

    def ending(last):
        tried = F.transform(
            F.filter(runs, lambda r: r["i"] <= last["i"]),
            lambda r: F.struct(
                (last["hi"] - r["lo"] - last["i"] + r["i"]).alias("n_equal"), (r["lo"] - last["hi"]).alias("m")
            ),
        )
        return F.array_max(
            F.filter(tried, lambda t: (t["n_equal"] >= MIN_WORDS) & (t["n_equal"] >= -MIN_SHARE * t["m"]))
        )

    return F.array_max(F.transform(runs, ending))


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_aligned, n_equal): verified overlaps, the best stretch of each pair.

    ``docs`` has doc_id and text, ``items`` has item_id and text.
    """
    item_words = items.select(F.col("item_id").cast("long").alias("item_id"), words_of("text").alias("words"))
    n_words = F.size("words")
    short = item_words.filter((n_words > 0) & (n_words < MIN_WORDS)).select(n_words.alias("n")).distinct()
    lengths = sorted(r.n for r in short.collect())
    item_seeds = materialize(
        seeds(item_words, lengths, True).select("item_id", F.size("words").alias("n_item"), F.col("at").alias("item_at"), "seed"), "item-seeds"
    )
    doc_words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of("text").alias("words"))
    found = seeds(doc_words, lengths, False).select("doc_id", "at", "seed")
    small = F.broadcast(item_seeds) if fits_broadcast(item_seeds) else item_seeds
    hits = found.join(small, "seed").select("doc_id", "item_id", "n_item", (F.col("at") - F.col("item_at")).alias("shift"))
    # Any place of a short item is as good as another, so a frequent one has one row per document.
    place = F.when(F.col("n_item") >= MIN_WORDS, F.col("shift")).alias("place")
    diagonals = hits.groupBy("doc_id", "item_id", "n_item", place).agg(F.min("shift").alias("shift"))
    spots = materialize(
        diagonals.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "n_item", "shift")).alias("spots")), "seed-hits"
    )
    met = attach(doc_words, spots, ["doc_id"], "inner", part_of=spots)
    lo = F.greatest(F.lit(0), -F.col("s.shift"))
    hi = F.least(F.col("s.n_item"), F.size("words") - F.col("s.shift"))
    cuts = (
        met.select("doc_id", "words", F.explode("spots").alias("s"))
        .select("doc_id", "s.item_id", "s.shift", "words", lo.alias("lo"), (hi - lo).alias("n"))
        .filter("n > 0")
        .select("doc_id", "item_id", "lo", "n", F.slice("words", F.col("shift") + F.col("lo") + 1, F.col("n")).alias("doc_part"))
    )
    both = attach(cuts, item_words.withColumnRenamed("words", "item_words"), ["item_id"], "inner", "item-words")
    item_part = F.slice("item_words", F.col("lo") + 1, F.col("n"))
    equal = F.zip_with("doc_part", item_part, lambda a, b: F.coalesce(a == b, F.lit(False)))
    compared = both.select("doc_id", "item_id", F.size("item_words").alias("n_item"), equal.alias("equal"))
    n_equal = F.size(F.filter("equal", lambda e: e))
    enough = compared.filter(n_equal >= F.least(F.col("n_item"), F.lit(MIN_WORDS)))
    verbatim = F.struct(F.col("n_item").alias("n_equal"), (-F.col("n_item")).alias("m"))
    judged = enough.select(
        "doc_id", "item_id", F.when(F.col("n_item") < MIN_WORDS, verbatim).otherwise(best_stretch(F.col("equal"))).alias("b")
    )
    best = judged.filter("b is not null").groupBy("doc_id", "item_id").agg(F.max("b").alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.m")).alias("n_aligned"), F.col("b.n_equal").alias("n_equal"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any verified overlap, all columns kept; rows without an id are kept."""
    leaked = overlaps(docs, items).select("doc_id").distinct().withColumn("__leak", F.lit(True))
    marked = attach(docs, leaked, ["doc_id"], "left", "leaks")
    return marked.filter(F.col("__leak").isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with the benchmark item it overlaps."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_aligned").cast("long"), F.col("n_equal").cast("long"))


def _sql() -> str:
    """Every aligned word of every diagonal with a hit, and every stretch of it."""
    words = "regexp_split_to_array(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"
    seed = " UNION ALL ".join(
        f"SELECT id, pos, '{m}' || concat_ws(' ', {', '.join(f'ws[pos + {i + 1}]' for i, b in enumerate(m) if b == '1')}) AS seed "
        f"FROM {{0}} WHERE pos + {len(m)} <= len(ws) AND len(ws) >= {MIN_WORDS}"
        for m in SEEDS
    )
    part = "{0} AS (SELECT {2} AS id, list_filter({3}, lambda w: w <> '') AS ws FROM {1} WHERE text IS NOT NULL)"
    at = ", ".join(part.format(a, b, c, words) for a, b, c in (("d", "documents", "doc_id"), ("i", "benchmark", "item_id")))
    return f"""
WITH {at},
dp AS (SELECT id, ws, unnest(range(len(ws))) AS pos FROM d), ip AS (SELECT id, ws, unnest(range(len(ws))) AS pos FROM i),
ds AS ({seed.format('dp')}), bs AS ({seed.format('ip')}),
spots AS (SELECT DISTINCT ds.id AS doc_id, bs.id AS item_id, ds.pos - bs.pos AS shift FROM ds JOIN bs USING (seed)),
aligned AS (
  SELECT doc_id, item_id, shift, unnest(range(len(iw.ws))) AS k, dw.ws AS dws, iw.ws AS iws
  FROM spots JOIN d dw ON dw.id = doc_id JOIN i iw ON iw.id = item_id
), equal AS (
  SELECT doc_id, item_id, shift, k, dws[k + shift + 1] = iws[k + 1] AS same FROM aligned WHERE k + shift BETWEEN 0 AND len(dws) - 1
), sums AS (
  SELECT *, sum(CASE WHEN same THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, item_id, shift ORDER BY k) AS c FROM equal
), stretches AS (
  SELECT a.doc_id, a.item_id, b.k - a.k + 1 AS n_aligned, b.c - a.c + 1 AS n_equal
  FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.shift = b.shift AND a.k <= b.k AND a.same AND b.same
  WHERE b.c - a.c + 1 >= {MIN_WORDS} AND b.c - a.c + 1 >= {MIN_SHARE} * (b.k - a.k + 1)
  UNION ALL
  SELECT d.id, i.id, len(i.ws), len(i.ws) FROM d JOIN i ON len(i.ws) BETWEEN 1 AND {MIN_WORDS - 1}
    AND contains(' ' || array_to_string(d.ws, ' ') || ' ', ' ' || array_to_string(i.ws, ' ') || ' ')
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, n_aligned) AS r FROM stretches
)
SELECT doc_id, item_id, n_aligned::BIGINT AS n_aligned, n_equal::BIGINT AS n_equal FROM best WHERE r = 1
"""


QUERIES = {"op10_decontamination": decontamination_query}
ORACLES = {"op10_decontamination": _sql()}
