"""Quality rules: lines that many documents of a host share are removed, and documents that keep too little are rejected.

Everything is column expressions: text statistics are array expressions inside the row, line frequency is two combinable aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpoint, let

SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: A document with fewer words, or a larger share (percent) of words in repeated windows, fails at once.
MIN_WORDS = 10
MAX_REPEATED = 20
#: A line is the host's own furniture if so many distinct documents show it, and so many percent of the host's distinct documents.
MIN_DOCS = 5
HOST_PERCENT = 5
#: A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.3


def words(text: Column) -> Column:
    """Runs of characters other than the six ASCII spaces; no words for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def lines(text: Column) -> Column:
    """The \\n-separated lines that hold a word, as they stand."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.trim(F.translate(x, SPACES, " " * len(SPACES)))) > 0)


def normalised(line: Column) -> Column:
    """Case, digits and spacing do not tell lines apart. The regular expressions run only where they have something to replace."""
    low = F.trim(F.translate(F.lower(line), SPACES, " " * len(SPACES)))
    spaced = F.when(F.contains(low, F.lit("  ")), F.regexp_replace(low, " +", " ")).otherwise(low)
    return let(spaced, lambda x: F.when(F.length(F.translate(x, "0123456789", "")) < F.length(x), F.regexp_replace(x, "[0-9]+", "0")).otherwise(x))


def repeated_words(hashes: Column) -> Column:
    """Words inside five-word windows that occur at least twice; hashes: one per word."""
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        """Every place opens a window of five words, cut where the next one opens."""
        following = F.concat(F.slice(places, 2, F.size(places)), F.array(F.element_at(places, -1) + WINDOW))
        return F.aggregate(F.zip_with(places, following, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(0), lambda a, x: a + x)

    def twice(sorted_pairs: Column) -> Column:
        """Of (window, place) in order: the places whose window equals that of the pair before or after."""
        hash_of = F.transform(sorted_pairs, lambda p: p["h"])
        before = F.concat(F.array(F.lit(None).cast("long")), F.slice(hash_of, 1, F.size(hash_of) - 1))
        after = F.concat(F.slice(hash_of, 2, F.size(hash_of)), F.array(F.lit(None).cast("long")))
        marked = F.zip_with(sorted_pairs, F.arrays_zip(before.alias("b"), after.alias("a")),
                            lambda p, n: F.when((p["h"] == n["b"]) | (p["h"] == n["a"]), p["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def from_windows(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(let(pairs, twice), covered))

    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(let(hashes, lambda h: let(windows(h), from_windows)))


def measured(docs: DataFrame, host: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, body, host, statistics, lines): what the rules need of each row, without its text.

    body is the hash of the text; lines holds (line, words) of each line with a word: the hash of the normalised line, its words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    by_word = let(words(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("again")))

    def described(x: Column) -> Column:
        return let(normalised(x), lambda y: F.struct(F.xxhash64(y).alias("line"), (F.length(y) - F.length(F.translate(y, " ", "")) + 1).alias("words")))

    by_line = let(lines(F.col(text)), lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).alias("dup"), F.transform(x, described).alias("lines")))
    found = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("body"), F.coalesce(F.xxhash64(F.col(host).cast("string")), F.lit(0)).alias("host"),
                        by_word.alias("w"), by_line.alias("l"), F.length(F.translate(whole, " " + SPACES, "")).cast("long").alias("word_chars"),
                        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    return found.select("id", "body", "host", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                        F.col("l.dup").cast("long").alias("n_dup_lines"), F.col("w.again").cast("long").alias("n_repeat_words"), "l.lines")


def fails_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED * n_words)


def common_lines(rows: DataFrame, min_docs: int = MIN_DOCS, host_percent: int = HOST_PERCENT) -> DataFrame:
    """Of measured rows: (host, line) shown by at least min_docs documents and host_percent of the documents of the host.

    A document counts once per line, and texts that agree in all their normalised lines count as one document, above and below the
    line of the share, so neither do copies of a text make its lines common, nor does a host's size. Documents without a line do not
    count. Null hosts form a host of their own.
    """
    whole = rows.where(F.size("lines") > 0).select("host", F.xxhash64("lines.line").alias("whole"), F.array_distinct("lines.line").alias("shown"))
    once = whole.groupBy("host", "whole").agg(F.first("shown").alias("shown"))
    by_line = once.select("host", F.explode("shown").alias("line")).groupBy("host", "line").agg(F.count("*").alias("docs"))
    hosts = whole.select("host", "whole").distinct().groupBy("host").agg(F.count("*").alias("total"))
    often = by_line.where(F.col("docs") >= min_docs).join(hosts, "host")
    return often.where(100 * F.col("docs") >= host_percent * F.col("total")).select("host", "line")


def removed_lines(rows: DataFrame, **limits: float) -> DataFrame:
    """(id, body, gone, gone_words) of each measured row with common lines: their hashes, and the words in them, repeats included.

    Rows are known by id and body, so repeated rows agree."""
    shown = rows.select("host", "id", "body", F.posexplode("lines").alias("at", "x")).select("host", "id", "body", "at", "x.line", "x.words")
    hits = shown.join(common_lines(rows, **limits), ["host", "line"], "left_semi")
    once = hits.groupBy("id", "body", "at").agg(F.max("words").alias("words"), F.max("line").alias("line"))
    return once.groupBy("id", "body").agg(F.collect_set("line").alias("gone"), F.sum("words").alias("gone_words"))


def _judged(docs: DataFrame, host: str, doc_id: str, text: str, **limits: float) -> DataFrame:
    """Measured rows with gone, n_removed_words, base_failed and kept. Texts are read once; the checkpoint holds 12 bytes a line."""
    rows = checkpoint(measured(docs, host, doc_id, text))
    gone = removed_lines(rows, **limits).withColumnsRenamed({"id": "gone_id", "body": "gone_body"})
    both = rows.drop("lines").join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("body") == F.col("gone_body")), "left")
    removed = F.coalesce(F.col("gone_words"), F.lit(0)).cast("long")
    failed = fails_base(F.col("n_words"), F.col("n_repeat_words"))
    enough = F.col("n_words") - removed >= LEFT_SHARE * F.col("n_words")
    return both.withColumns({"n_removed_words": removed, "base_failed": failed, "kept": ~failed & enough})


def judge(docs: DataFrame, host: str = "source", doc_id: str = "doc_id", text: str = "text", **limits: float) -> DataFrame:
    """doc_id, text statistics, n_removed_words, base_failed, kept; one row per input row.

    Null or empty texts have no words and fail. Null ids are judged like others; null hosts are one host. Other columns are not read.
    """
    return _judged(docs, host, doc_id, text, **limits).select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                              "n_repeat_words", "n_removed_words", "base_failed", "kept")


def clean(docs: DataFrame, **limits: float) -> DataFrame:
    """The columns of documents, for those that stay: common lines are taken out of their texts and n_chars follows.

    Statistics are those of the text as it came. The order of the lines that stay is kept; repeated rows stay repeated.
    """
    names = docs.columns
    stay = _judged(docs, "source", "doc_id", "text", **limits).where("kept").select("id", "body", "gone").dropDuplicates(["id", "body"])
    wide = docs.select(F.struct(*names).alias("row"), F.xxhash64("text").alias("row_body"))
    both = wide.join(stay, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("row_body") == F.col("body")))
    text = F.col("row.text")
    rest = let(F.col("gone"), lambda gone: F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(normalised(x)))), "\n"))
    new = F.when(F.col("gone").isNull(), text).otherwise(rest)
    return both.withColumn("new_text", new).select(*[
        F.col("new_text").alias(n) if n == "text" else F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.length("new_text")).cast(docs.schema[n].dataType).alias(n)
        if n == "n_chars" else F.col(f"row.{n}").alias(n) for n in names])
