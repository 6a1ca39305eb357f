"""Quality rules, lines first, with DataFrame functions only.

Every line is judged on its own by three families of rules; blank lines are not judged:

* punctuation: more than LINE_SYMBOLS of its word characters are symbols or runs of
  exclamation and question marks, it has words but no letter or digit, or it has
  UNPUNCTUATED words and no punctuation mark at all;
* navigation: a short line with two separators that stand alone between words, a line of
  menu words only, or a caption in capitals;
* boilerplate: a short line with a fixed phrase of licenses, notices or calls to action.

Lines that fail are removed. A document is kept if it passes the base rules (enough words,
few words in repeated passages, both over the whole text as given) and loses at most
MAX_LOSS of its word characters with the lines.

Everything is computed inside the row: no shuffle, no Python, cost linear in the text but
for one sort per text that repeats itself. A word window is known by a chain of 64-bit
hashes; windows with equal hashes are compared word by word.

Null, empty and blank texts have no words, fail the base rules and have the cleaned text
'' (null for null). Rows without doc_id and repeated rows are judged like any other. Only
``doc_id`` and ``text`` are read, so extra columns may have any name. An empty table gives
no rows. There is no bound on the length of a text and no tie to break.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.llm.common import table

#: Base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30  # per cent of the words
#: Lines.
LINE_SYMBOLS = 10  # per cent of the word characters
UNPUNCTUATED = 20
SHORT_LINE = 12
NOTICE_LINE = 30
CAPITALS = 60  # per cent of the letters
CAPTION_LETTERS = 10
MAX_LOSS = 50  # per cent of the word characters

#: Characters, words and phrases the rules look for.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SYMBOL = "[" + SYMBOLS + "]"
MARK_RUNS = r"[!?]{2,}"
MARKS = r"[.,;:!?…]"
ALONE = r"[\x20\x09-\x0D][|»›>•·/][\x20\x09-\x0D][^\n]*[\x20\x09-\x0D][|»›>•·/][\x20\x09-\x0D]"
MENU = (
    "home menu login logout register search next previous back top share print contact about sitemap help faq "
    "startseite suche weiter kontakt impressum accueil recherche suivant inicio buscar siguiente contacto"
).split()
PHRASES = (
    "all rights reserved",
    "alle rechte vorbehalten",
    "tous droits réservés",
    "todos los derechos reservados",
    "licensed under",
    "copyright",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie",
    "javascript",
    "lorem ipsum",
    "click here",
    "read more",
    "subscribe to",
    "sign up for",
    "follow us on",
)
NOTICE = "(" + "|".join(PHRASES) + ")"


def _words(text: Column) -> Column:
    """Words of a text; none for null or blank texts."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.split(bare, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def _without(text: Column, kept: str) -> Column:
    """Characters of a text that the character class ``kept`` names, counted."""
    return F.char_length(F.regexp_replace(text, f"[^{kept}]+", ""))


def line_rule(x: Column) -> Column:
    """Name of the first rule that a line fails; null for good and for blank lines.

    ``x`` has the line, its words, and how many characters and symbols they hold. Cheap tests come
    first: most lines need no count of letters and no search for phrases.
    """
    line, n = x["line"], F.size(x["words"])
    doubled = [F.contains(line, F.lit(a + b)) for a in "!?" for b in "!?"]
    runs = F.char_length(line) - F.char_length(F.regexp_replace(line, MARK_RUNS, ""))
    marks = x["symbols"] + F.when(reduce(lambda a, b: a | b, doubled), runs).otherwise(0)
    punctuation = (
        (100 * marks > LINE_SYMBOLS * x["chars"])
        | ~line.rlike(r"[\p{L}\p{N}]")
        | ((n >= UNPUNCTUATED) & ~line.rlike(MARKS))
    )
    upper = _without(line, r"\p{Lu}")
    letters = _without(line, r"\p{L}")
    capitals = (100 * upper > CAPITALS * CAPTION_LETTERS) & (letters >= CAPTION_LETTERS) & (100 * upper > CAPITALS * letters)
    navigation = ((n <= SHORT_LINE) & line.rlike(ALONE)) | F.forall(x["words"], lambda w: F.lower(w).isin(MENU)) | capitals
    boilerplate = (n <= NOTICE_LINE) & F.lower(line).rlike(NOTICE)
    return (
        F.when(x["chars"] == 0, F.lit(None).cast("string"))
        .when(punctuation, F.lit("punctuation"))
        .when(navigation, F.lit("navigation"))
        .when(boilerplate, F.lit("boilerplate"))
    )


def _tail(a: Column, k: int) -> Column:
    """The array without its first ``k`` entries."""
    return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))


def _head(a: Column, k: int) -> Column:
    """The array without its last ``k`` entries."""
    return F.slice(a, 1, F.greatest(F.size(a) - k, F.lit(0)))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside windows that occur twice or more, from ``words`` and the windows' ``prints``.

    Step by step, so that no step is computed twice; texts without equal prints have empty lists.
    """
    repeats = F.size(F.array_distinct("prints")) < F.size("prints")
    placed = F.sort_array(F.transform("prints", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    rows = rows.withColumn("placed", F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))

    def equal(a, b):
        same = F.slice("words", a["p"] + 1, WINDOW) == F.slice("words", b["p"] + 1, WINDOW)
        return (a["h"] == b["h"]) & same

    rows = rows.withColumn("as_next", F.zip_with(_head(F.col("placed"), 1), _tail(F.col("placed"), 1), equal))
    no = F.array(F.lit(False))
    twice = F.zip_with(F.concat(no, "as_next"), F.concat("as_next", no), lambda a, b: a | b)
    found = F.zip_with("placed", twice, lambda x, t: F.when(t, x["p"]))
    rows = rows.withColumn("at", F.sort_array(F.filter(found, lambda p: p.isNotNull())))
    # A window covers its words up to the next window that was found.
    steps = F.zip_with(_head(F.col("at"), 1), _tail(F.col("at"), 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s) + WINDOW
    covered = F.when(F.size("at") > 0, covered).otherwise(F.lit(0)).cast("long")
    return rows.withColumn("n_repeat_words", covered).drop("placed", "as_next", "at")


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, the rule each line fails, the cleaned text and the verdict of every row.

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines,
    n_removed_lines, removed_chars, rules, cleaned): ``rules`` has one entry per line, null if it stays.
    """
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    rows = docs.select("doc_id", F.col("text").isNull().alias("absent"), lines.alias("lines"))
    # Every line is split into words once; the words of the text are those of its lines.
    cut = F.transform("lines", lambda x: F.struct(x.alias("line"), _words(x).alias("words")))
    rows = rows.select("doc_id", "absent", cut.alias("lines"))
    measured = F.transform(
        "lines",
        lambda x: F.struct(
            x["line"].alias("line"),
            x["words"].alias("words"),
            F.char_length(F.array_join(x["words"], "")).cast("long").alias("chars"),
            F.regexp_count(x["line"], F.lit(SYMBOL)).cast("long").alias("symbols"),
        ),
    )
    rows = rows.select("doc_id", "absent", measured.alias("lines"))
    rows = rows.withColumn("words", F.flatten(F.transform("lines", lambda x: x["words"])))
    # Prints of windows of 2, 4 and 8 words, each from two neighbours of the one before.
    rows = rows.withColumn("prints", F.transform("words", lambda w: F.xxhash64(w)))
    for k in (1, 2, 4):
        pair = F.zip_with(_head(F.col("prints"), k), _tail(F.col("prints"), k), lambda a, b: F.xxhash64(a, b))
        rows = rows.withColumn("prints", pair)
    rows = _with_repeats(rows)
    judged = F.transform("lines", lambda x: F.struct(*[x[c].alias(c) for c in ("line", "chars", "symbols")], line_rule(x).alias("rule")))
    rows = rows.select("doc_id", "absent", F.size("words").cast("long").alias("n_words"), "n_repeat_words", judged.alias("lines"))

    def total(lines: Column, of: str) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda done, x: done + x[of])

    filled = F.transform(F.filter("lines", lambda x: x["chars"] > 0), lambda x: x["line"])
    bad = F.filter("lines", lambda x: x["rule"].isNotNull())
    good = F.filter("lines", lambda x: x["rule"].isNull())
    rows = rows.withColumns({"filled": filled, "bad": bad})
    rows = rows.select(
        "doc_id",
        "n_words",
        total(F.col("lines"), "chars").alias("word_chars"),
        total(F.col("lines"), "symbols").alias("n_symbols"),
        (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("filled").cast("long").alias("n_lines"),
        F.size("bad").cast("long").alias("n_removed_lines"),
        total(F.col("bad"), "chars").alias("removed_chars"),
        F.transform("lines", lambda x: x["rule"]).alias("rules"),
        F.when(~F.col("absent"), F.array_join(F.transform(good, lambda x: x["line"]), "\n")).alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (100 * F.col("removed_chars") <= MAX_LOSS * F.col("word_chars"))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select(*counts, kept.alias("kept"), "n_lines", "n_removed_lines", "removed_chars", "rules", "cleaned")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and counts of every document."""
    return judge(table(spark, sf_dir, "documents")).drop("rules", "cleaned")


def _sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    spaces = " || ".join(f"chr({ord(c)})" for c in SPACES)

    def length(of: str, without: str) -> str:
        return f"length(translate({of}, {without}, ''))"

    symbols = quoted(SYMBOLS)
    words = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    plain = "lower(l)"
    runs = f"length(l) - length(regexp_replace(l, {quoted(MARK_RUNS)}, '', 'g'))"
    upper, letters = "len(regexp_extract_all(l, '\\p{Lu}'))", "len(regexp_extract_all(l, '\\p{L}'))"
    tests = {
        "punctuation": [
            f"100 * (length(l) - {length('l', symbols)} + {runs}) > {LINE_SYMBOLS} * {length('l', spaces)}",
            "NOT regexp_matches(l, '[\\p{L}\\p{N}]')",
            f"n >= {UNPUNCTUATED} AND NOT regexp_matches(l, {quoted(MARKS)})",
        ],
        "navigation": [
            f"n <= {SHORT_LINE} AND regexp_matches(l, {quoted(ALONE)})",
            f"len(list_filter({words.format(plain)}, lambda x: x NOT IN ({', '.join(map(quoted, MENU))}))) = 0",
            f"{letters} >= {CAPTION_LETTERS} AND 100 * {upper} > {CAPITALS} * {letters}",
        ],
        "boilerplate": [f"n <= {NOTICE_LINE} AND regexp_matches({plain}, {quoted(NOTICE)})"],
    }
    bad = reduce(lambda a, b: f"{a} OR {b}", (f"({t})" for ts in tests.values() for t in ts))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, {words.format('text')} AS words FROM d),
windows AS (
  SELECT r, s, array_to_string(words[s:s + {WINDOW - 1}], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS s FROM w)
), twice AS (SELECT r, unnest(list(s)) AS s FROM windows GROUP BY r, win HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(s, s + {WINDOW})) AS k FROM twice) GROUP BY r
), lines AS (
  SELECT r, l, len({words.format('l')}) AS n, {length('l', spaces)} AS chars
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
), judged AS (SELECT r, l, chars, ({bad}) AS bad FROM lines WHERE chars > 0),
sums AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dups, count(*) FILTER (bad) AS gone,
         coalesce(sum(chars) FILTER (bad), 0) AS removed FROM judged GROUP BY r
), counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, {length('text', spaces)}::BIGINT AS word_chars,
         (length(text) - {length('text', symbols)})::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
         coalesce(gone, 0)::BIGINT AS n_removed_lines, coalesce(removed, 0)::BIGINT AS removed_chars
  FROM d JOIN w USING (r) LEFT JOIN repeated USING (r) LEFT JOIN sums USING (r)
), failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND 100 * removed_chars <= {MAX_LOSS} * word_chars AS kept FROM failed
"""


QUERIES = {"op13_quality": quality_query}
ORACLES = {"op13_quality": _sql()}
