"""Quality rules: base counts of a text and a log-likelihood ratio.

The words of trusted documents (labelled of good quality) and of the whole
corpus give two multinomials over hashed word n-grams (one and two words).  A
document's score is the mean, over its own n-grams, of the log of their ratio;
it is kept if the score reaches the threshold and the base rules hold.  All
work is done by DataFrame functions.

Base counts (words are runs of characters other than space and \\t to \\r):
``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored

BUCKETS = 8192
#: Added to every bucket's count in the corpus multinomial.
SMOOTHING = 1.0
#: N-grams that the trusted multinomial is given beforehand, dealt as in the
#: corpus, so that few trusted documents judge little.
PRIOR = 8192.0
#: Mean log-likelihood ratio that a document must reach.  Trusted documents
#: are the bulk of the corpus, so their own scores lie around 0.
LEAST_SCORE = -0.08
#: Ids of trusted documents that are broadcast (16 bytes each) at most; beyond
#: that the join shuffles.
BROADCAST_IDS = 2_000_000
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def words_of(text: Column) -> Column:
    """Words of a text (null: none), by one split on single spaces."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def _with_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("words", words_of(F.col("text")))


def n_repeat_words(words: Column) -> Column:
    """Words inside five-word windows found twice or more, the first included.

    Windows are sorted by hash within the row; a window beside an equal one
    repeats; sorted by place again, each adds the words up to the next one.
    Linear memory, n log n time, whatever repeats.
    """
    last = F.size(words) - WINDOW
    at = F.sequence(F.lit(1), last + 1)
    window = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i - 1 + j) for j in range(WINDOW)]))

    def spread(hashes: Column) -> Column:
        # (hash, place) in order of hash; places whose neighbour has the same hash
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.transform(F.array(pairs), lambda p: _covered(p))[0]

    repeated = F.transform(F.array(window), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), spread(h)).otherwise(F.lit(0)))[0]
    return F.when(last >= 0, repeated).otherwise(F.lit(0)).cast("long")


def _covered(pairs: Column) -> Column:
    """Words covered by the windows of sorted (hash, place) pairs that repeat."""
    n = F.size(pairs)
    places = F.transform(pairs, lambda p, k: F.when(
        (p["h"] == F.get(pairs, k - 1)["h"]) | ((k + 1 < n) & (p["h"] == F.get(pairs, k + 1)["h"])), p["i"]))
    places = F.array_sort(F.filter(places, lambda i: i.isNotNull()))
    return F.transform(F.array(places), lambda s: F.aggregate(
        s, F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum"), i.alias("last")),
        lambda acc: acc["sum"]))[0]


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    df = _with_words(docs)
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, SPACES)) > 0)
    return df.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"))


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with one array: the log ratio of each bucket (at most ``BUCKETS``).

    Counts cover every n-gram of every document: exploded pairs of neighbours
    are counted per bucket before anything is shuffled.
    """
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn("good", F.lit(True))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    df = _with_words(docs).select("doc_id", "words").join(good, "doc_id", "left")
    next_ = F.concat(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    pairs = df.where(F.size("words") > 0).select(
        F.coalesce("good", F.lit(False)).alias("good"), F.inline(F.arrays_zip(F.col("words").alias("a"), next_.alias("b"))))
    each = pairs.select("good", F.explode(F.array(
        _bucket(F.col("a")), F.when(F.col("b").isNotNull(), _bucket(F.col("a"), F.col("b"))))).alias("bucket"))
    totals = each.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("good"), 1)).alias("trusted"))
    every = F.sort_array(F.collect_list(F.struct("bucket", "raw", "trusted")))  # a struct per bucket
    summed = totals.agg(every.alias("counts"), F.sum("raw").alias("n_raw"), F.sum("trusted").alias("n_trusted"))
    filled = F.map_from_entries(F.transform("counts", lambda c: F.struct(c["bucket"], c)))
    def log_ratio(b: Column) -> Column:
        count = F.col("filled")[b]
        corpus = (F.coalesce(count["raw"], F.lit(0)) + SMOOTHING) / (F.col("n_raw") + SMOOTHING * BUCKETS)
        trusted = (F.coalesce(count["trusted"], F.lit(0)) + PRIOR * corpus) / (F.col("n_trusted") + PRIOR)
        return F.log(trusted / corpus)

    value = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), log_ratio)
    return summed.withColumn("filled", filled).select(F.when(F.col("n_trusted") > 0, value).alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score.

    Null text has no words: all counts 0, base_failed, not kept, score null.
    Repeated rows are judged one by one.  Without trusted documents there is no
    ratio: scores are 0 and the base rules alone decide.

    The rows are written once and read: a filter on them would else be pushed
    into the counts, which hold values that must be made only once.
    """
    ratio = ratios(docs, labels).scalar()
    words = F.col("words")
    score = F.aggregate(
        words, F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("string").alias("last")),
        lambda acc, w: F.struct(
            (acc["sum"] + F.get(F.col("ratio"), _bucket(w))
             + F.when(acc["last"].isNull(), 0.0).otherwise(F.get(F.col("ratio"), _bucket(acc["last"], w)))).alias("sum"),
            w.alias("last")),
        lambda acc: acc["sum"])
    df = base_counts(docs).withColumn("ratio", ratio)
    mean = F.when(F.col("n_words") == 0, F.lit(None).cast("double")).when(F.col("ratio").isNull(), F.lit(0.0)).otherwise(
        score / (2 * F.col("n_words") - 1))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    scored = df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), mean.alias("score"))
    scored = stored(docs.sparkSession, scored, "quality-judged")
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= least, F.lit(False)))
