"""Quality rules: base counts of a document, and cross-document line frequency.

Lines are normalised (lower case, single spaces) and hashed. For each host (the ``source``) the distinct
documents that hold a line are counted. Copies (the same set of lines) count once. So do near copies: pages that share lines above the
limits are told apart by the smallest hash among their own lines, which are those neither above the limits nor edited from
such a line of the host. A line of ``EDIT_WORDS`` words or more is edited from another when most of their words agree in place: its first
two thirds, its last two thirds or both its outer thirds, one word more or less allowed. Shorter lines are own lines.
Pages without own lines are near copies and told by their rarest line above the limits. A line above the limits (a share of the host's
documents, and a least number) is boilerplate and is removed. A document is rejected if it fails the base rules, or if too few words remain.

DataFrame functions only. One pass over the texts writes a small table (counts and
line hashes, no text); the distinct lines of each page come from it with partial aggregates, so copies, a host or a line
that hold a third of all rows are merged in each task before they are shuffled or joined.

Null text: no words. Null source: the empty host. Null ``doc_id`` and repeated rows are kept,
equal rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, written

SPACE = " \t\n\x0b\f\r"
SPACES = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
MIN_DOCS, HOST_PERCENT, MIN_LEFT_PERCENT = 20, 2, 30
EDIT_WORDS = 8


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def _norm(line: Column) -> Column:
    return F.lower(F.regexp_replace(_trim(line), SPACES, " "))


def line_hash(norm: Column) -> Column:
    return F.substring(F.md5(norm.cast("binary")), 1, 16)


def line_edges(words: Column) -> Column:
    """Hashes by which a line and its edits meet: of its first and last two thirds and of both outer thirds, with the number of
    words; then the same as if it had one word less or more. None for a short line. ``words``: hashes of its words."""
    n = F.size(words)

    def of(m: Column) -> list[Column]:
        third = F.ceil(m / 3).cast("int")
        head = lambda k: F.slice(words, F.lit(1), k)
        tail = lambda k: F.slice(words, n - k + 1, k)
        parts = ((F.lit("head"), head(m - third)), (F.lit("tail"), tail(m - third)), (head(third), tail(third)))
        return [F.when(m >= EDIT_WORDS, F.hash(m, *p)) for p in parts]
    return F.when(n >= EDIT_WORDS - 1, F.array(*of(n), *of(n - 1), *of(n + 1)))


def repeat_words(df: DataFrame, words: str, n: int = WINDOW) -> DataFrame:
    """Adds n_repeat_words: words inside n-word windows that occur twice or more in the array ``words``.

    Windows are compared by hashes of word hashes. Only documents in which windows repeat sort them.
    """
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    last = F.size("_h") - n
    h = F.col("_h")
    gram = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[h[i + k] for k in range(n)]))
    df = df.withColumn("_g", F.when(last >= 1, gram))
    df = df.withColumn("_again", F.coalesce(F.size(F.array_distinct("_g")) < F.size("_g"), F.lit(False)))
    pairs = F.transform("_g", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    df = df.withColumn("_s", F.when(F.col("_again"), F.sort_array(pairs)))
    s, top = F.col("_s"), F.size("_s") - 1
    found = F.filter(F.sequence(F.lit(0), top), lambda j: (
        ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["x"] == s[j]["x"]))
        | ((j < top) & (s[F.least(j + 1, top)]["x"] == s[j]["x"]))))
    df = df.withColumn("_at", F.when(F.col("_again"), F.sort_array(F.transform(found, lambda j: s[j]["i"]))))
    at = F.col("_at")
    steps = F.when(F.size(at) > 1, F.aggregate(F.sequence(F.lit(1), F.size(at) - 1), F.lit(0).cast("long"),
                   lambda total, j: total + F.least(F.lit(n), at[j] - at[j - 1]).cast("long"))).otherwise(F.lit(0).cast("long"))
    covered = F.when(F.col("_again"), steps + n).otherwise(F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", covered).drop("_h", "_g", "_again", "_s", "_at")


def measure(docs: DataFrame) -> DataFrame:
    """Base counts and line hashes of each row; no text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                     F.xxhash64("doc_id", text).alias("row"), text.alias("text"))
    words = F.when(_trim(F.col("text")) == "", F.array().cast("array<string>")).otherwise(F.split(_trim(F.col("text")), SPACES))
    df = df.withColumn("words", words)
    df = repeat_words(df, "words").withColumn("n_words", F.size("words").cast("long")).drop("words")
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: _trim(x) != ""))
    df = df.withColumn("norms", F.transform("lines", _norm))
    df = df.withColumn("hashes", F.transform("norms", line_hash))
    df = df.withColumn("marks", F.transform("norms", lambda x: F.transform(F.split(x, " "), lambda w: F.hash(w))))
    return df.select(
        "doc_id", "host", "row", "n_words", F.length(_without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.xxhash64(F.sort_array(F.array_distinct("hashes"))).alias("copy"), "hashes",
        F.transform("marks", line_edges).alias("edges"), F.transform("marks", lambda x: F.size(x)).alias("line_words"))


def boilerplate(measured: DataFrame, min_docs: int = MIN_DOCS, host_percent: float = HOST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Occurrences of lines (row, host, line, words), and the lines above the limits (host, line)."""
    lines = (measured.select("row", "host", F.explode(F.arrays_zip("hashes", "line_words")).alias("x"))
             .select("row", "host", F.col("x.hashes").alias("line"), F.col("x.line_words").alias("words")))
    docs = measured.groupBy("host").agg(F.count("*").alias("host_docs"))
    page = ["host", "copy"]
    held = written(measured.select(*page, F.explode(F.arrays_zip("hashes", "edges")).alias("x"))
                   .select(*page, F.col("x.hashes").alias("line"), F.col("x.edges").alias("edges")).distinct(), "page-lines")

    def above(counted: DataFrame) -> DataFrame:
        return (counted.where(F.col("n_docs") > min_docs).join(docs, "host")
                .where(F.col("n_docs") * 100 > F.col("host_docs") * host_percent).select("host", "line", "n_docs"))
    common = written(above(held.groupBy("host", "line").agg(F.count("*").alias("n_docs"))), "common-lines")
    sharing = held.join(common, ["host", "line"], "left_semi").select(page).distinct()
    held = written(held.join(sharing, page, "left_semi").join(common, ["host", "line"], "left"), "held-lines")
    own, shared = held.where("n_docs is null"), held.where("n_docs is not null")
    edges = shared.select("host", F.explode(F.slice("edges", 1, 3)).alias("edge")).where("edge is not null").distinct()
    edited = (own.select(*page, "line", F.explode("edges").alias("edge")).where("edge is not null")
              .join(edges, ["host", "edge"], "left_semi").select(*page, "line").distinct())
    own = own.join(edited, [*page, "line"], "left_anti").groupBy(page).agg(F.min("line").alias("own"))
    rarest = F.min(F.struct("n_docs", "line"))["line"]
    signs = shared.groupBy(page).agg(rarest.alias("rarest"), F.collect_list("line").alias("lines")).join(own, page, "left")
    often = above(signs.select("host", F.coalesce("own", "rarest").alias("sign"), F.explode("lines").alias("line"))
                  .groupBy("host", "line").agg(F.countDistinct("sign").alias("n_docs"))).select("host", "line")
    return lines, often


def judge(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          min_docs: int = MIN_DOCS, host_percent: float = HOST_PERCENT, min_left_percent: int = MIN_LEFT_PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): counts, base_failed, removed_words, removed_lines (hashes), kept, row."""
    measured = written(measure(docs), "measured")
    lines, often = boilerplate(measured, min_docs, host_percent)
    gone = (lines.join(often, ["host", "line"]).groupBy("row", "host")
            .agg(F.sum("words").alias("all_words"), F.collect_set("line").alias("removed_lines")))
    copies = measured.groupBy("row", "host").agg(F.count("*").alias("copies"))
    gone = (gone.join(copies, ["row", "host"])
            .select("row", "host", (F.col("all_words") / F.col("copies")).cast("long").alias("removed_words"), "removed_lines"))
    df = measured.drop("hashes", "line_words", "copy", "edges").join(gone, ["row", "host"], "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    left = F.col("n_words") - removed
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    depleted = (removed > 0) & ((left < min_words) | (left * 100 < F.col("n_words") * min_left_percent))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), removed.alias("removed_words"),
                     "removed_lines", "row", "host")


def clean(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, without the lines above the limits; columns as in ``docs``."""
    row, host, lines = names = [free_name(docs, c) for c in ("row", "host", "lines")]
    verdict = judge(docs, **options).where("kept").select("row", "host", "removed_lines").distinct().toDF(*names)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({row: F.xxhash64("doc_id", text), host: F.coalesce(F.col("source").cast("string"), F.lit(""))})
    stays = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(lines, line_hash(_norm(x))))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return marked.join(verdict, [row, host]).withColumn("text", text).select(*docs.columns)
