"""Quality rules: base counts of a text, and the hashed n-gram log-likelihood ratio of a trusted target
against the raw corpus. DataFrame functions only; documents are not shuffled (unless their
trusted ids are too many to broadcast), only bucket counts are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenyard.llm.common import staged, with_added, words

#: Hash buckets that all n-grams fall into; also the bound of the fitted table.
BUCKETS = 1 << 14
#: Trusted ids up to which they are broadcast to the documents (about 100 MB); more of them are joined by a shuffle.
BROADCAST_TRUSTED = 4_000_000
#: Highest mean log ratio per n-gram below which a document is rejected; see :func:`fit_threshold`.
THRESHOLD = -0.065
#: Positions packed beside a hash in the sort of 3-word windows; longer documents sort (hash, position) pairs.
_POS_BITS = 17


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids all of whose labels say good quality and not toxic; every third is for ``checking``, the others for
    fitting."""
    good = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min("quality").alias("q"), F.max("toxic").alias("x"))
            .where((F.col("q") == 1) & (F.coalesce("x", F.lit(0)) == 0)))
    return good.select("doc_id", (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(3)) == 0).alias("checking"))


def _join_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents beside some of the trusted ids; the documents stay where they are while the ids are few."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_TRUSTED else ids, "doc_id", how)


def _bucket(buckets: int, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def fit_log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with ``ratios``: log(p_target / p_raw) per bucket, both multinomials with one added to each count.

    The raw counts cover all words of all documents, the target counts all words of the trusted ones for fitting.
    Without trusted words all ratios are 0. The row's size is bounded by ``buckets``.
    """
    spark = docs.sparkSession
    good = trusted_ids(labels).where("NOT checking").select("doc_id", F.lit(1).alias("good"))
    flagged = _join_ids(docs.select("doc_id", "text"), good, "left").select("good", words(F.col("text")).alias("w"))
    following = F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0)))
    at = flagged.select("good", F.explode(F.arrays_zip(F.col("w").alias("a"), following.alias("b"))).alias("g"))
    one_two = F.array(_bucket(buckets, F.col("g.a")),
                      F.when(F.col("g.b").isNotNull(), _bucket(buckets, F.col("g.a"), F.col("g.b"))))
    counts = (at.select("good", F.explode(one_two).alias("b")).where("b IS NOT NULL")
              .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("target")))
    every = spark.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("b"))
    one = (every.join(counts, "b", "left")
           .select("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
           .agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("c"),
                F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target")))
    offset = F.log((F.col("n_raw") + buckets) / (F.col("n_target") + buckets))
    return one.select(F.transform("c", lambda x: F.when(
        F.col("n_target") > 0, F.log((x["target"] + 1) / (x["raw"] + 1)) + offset).otherwise(0.0)).alias("ratios"))


def fit_threshold(docs: DataFrame, labels: DataFrame, ratios: DataFrame, buckets: int = BUCKETS,
                  highest: float = THRESHOLD) -> DataFrame:
    """One row with ``threshold``: what all but a hundredth of the trusted documents that were not fitted reach, at
    most ``highest``.

    Their discrete first percentile, so of fewer than a hundred the least; a small target, which knows few of the
    words of good documents, does not reject them, and junk below them goes at every size.
    """
    check = trusted_ids(labels).where("checking").select("doc_id")
    scored = quality_scores(_join_ids(docs.select("doc_id", "text"), check, "left_semi"), ratios, None, buckets)
    return (scored.where("NOT base_failed")
            .agg(F.expr("percentile_disc(0.01) WITHIN GROUP (ORDER BY score)").alias("low"))
            .select(F.least(F.coalesce("low", F.lit(highest)), F.lit(highest)).alias("threshold")))


def quality_scores(docs: DataFrame, ratios: DataFrame, threshold: DataFrame | None, buckets: int = BUCKETS) -> DataFrame:
    """All input columns and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept``.

    ``score`` is the mean log ratio over the document's words and word pairs (0.0 without words); ``kept`` is
    false if ``base_failed`` (fewer than 50 words, or over half of them in repeated 3-word windows), else
    ``score >= threshold`` (one row; None: no threshold). Null text: no words. An input column with one of these names is replaced.
    Every row is judged for itself: repeated rows and ids do not matter.
    """
    table = F.col("ratios")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    base = docs.select(F.struct("*").alias("row")).select(
        "row", words(F.col("row.text")).alias("w"), ratios.scalar().alias("ratios"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    w = F.col("w")
    n = F.size(w)
    ratio = F.aggregate(
        F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), F.lit(0.0),
        lambda acc, i: acc + F.get(table, _bucket(buckets, F.get(w, i)))
        + F.when(n > 1, F.get(table, _bucket(buckets, F.get(w, i), F.get(w, i + 1)))).otherwise(0.0))
    tail = F.when(n > 1, F.get(table, _bucket(buckets, F.get(w, n - 1)))).otherwise(0.0)
    mask = (1 << _POS_BITS) - 1
    short = n <= mask

    def window(x, i):
        return F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))

    def within(array):  # without the last two positions, which start no window
        return F.slice(array, F.lit(1), F.greatest(n - 2, F.lit(0)))

    first = base.select(
        "row", "w", n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(n > 0, (ratio + tail) / (2 * n - 1)).otherwise(0.0).alias("score"),
        F.when(short, F.sort_array(within(F.transform(
            w, lambda x, i: F.shiftleft(window(x, i), _POS_BITS).bitwiseOR(i.cast("long")))))).alias("packed"),
        F.when(~short, F.sort_array(within(F.transform(
            w, lambda x, i: F.struct(window(x, i).alias("h"), i.cast("long").alias("i")))))).alias("pairs"))
    packed, pairs = F.col("packed"), F.col("pairs")

    def equal_words(i, j):
        return (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))

    def place(x):
        return x.bitwiseAND(F.lit(mask)).cast("int")

    def same(x, y):
        return F.coalesce((F.shiftright(x, _POS_BITS) == F.shiftright(y, _POS_BITS))
                          & equal_words(place(x), place(y)), F.lit(False))

    def alike(x, y):
        return F.coalesce((x["h"] == y["h"]) & equal_words(x["i"].cast("int"), y["i"].cast("int")), F.lit(False))

    # neighbours of the sorted windows that are equal: both positions, each at most twice
    found = F.when(F.col("packed").isNotNull(), F.flatten(
        F.filter(F.transform(packed, lambda x, i: F.when(same(x, F.get(packed, i + 1)), F.array(
            x.bitwiseAND(F.lit(mask)), F.get(packed, i + 1).bitwiseAND(F.lit(mask))))), lambda x: x.isNotNull()))).otherwise(F.flatten(
            F.filter(F.transform(pairs, lambda x, i: F.when(alike(x, F.get(pairs, i + 1)), F.array(
                x["i"], F.get(pairs, i + 1)["i"]))), lambda x: x.isNotNull())))
    second = first.select(
        "row", "n_words", "word_chars", "n_symbols", "score",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array_distinct(found).alias("found"))
    third = second.select("row", "n_words", "word_chars", "n_symbols", "score", "n_dup_lines",
                          F.sort_array("found").alias("p"))
    p = F.col("p")
    covered = F.aggregate(F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    # inline keeps a later filter on the verdict from being pushed through (and so computed along) all of the above
    last = third.select("row", F.inline(F.array(F.struct(
        "n_words", "word_chars", "n_symbols", "score", "n_dup_lines", covered.alias("n_repeat_words")))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return with_added("row", last, {
        **{c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
        "base_failed": failed, "score": F.col("score"),
        "kept": ~failed & (F.col("score") >= threshold.scalar()) if threshold is not None else ~failed})


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                  highest: float = THRESHOLD) -> DataFrame:
    """Fit the log ratios on the whole table, then judge every document (see the steps above)."""
    ratios = staged(fit_log_ratios(docs, labels, buckets), "quality-ratios")
    threshold = staged(fit_threshold(docs, labels, ratios, buckets, highest), "quality-threshold")
    return quality_scores(docs, ratios, threshold, buckets)
