"""The inverted index of the learner, from a pair of tokens to the words that hold it.

A posting ``(pair, word_id, toks, freq)`` carries its word, so a lookup is one read of the postings of the wanted
pairs and needs no join with the words. Postings are range-partitioned and sorted by pair (a pair that most words hold
spreads over several files, as the word number is part of the range) and written as Parquet with small pages, so the
scan's pushed-down filter reads little beyond the wanted pairs.

Merges change words. The index is not rewritten for that: each round appends a layer with the pairs that its merges
made, and a posting's word is brought up to date when it is read, by replaying the merges committed since its layer was
written. A posting whose word no longer holds its pair is passed over. Every few rounds the newest layers are folded into
one; an older layer joins them once they have grown to half its rows or STALE_MERGES have passed since it was written, so
folding costs in proportion to the postings that merges make, not to the index.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import merged_string, pair_string
from ..session import scratch_path
from .counts import pair_occurrences

#: Rows of a Parquet page: what a lookup may read beyond its pairs, per file and pair at most twice.
PAGE_ROWS = 1000
#: Postings in one file on average.
FILE_ROWS = 2_000_000
#: Merges that a lookup replays at most on a posting before its layer is folded, and the share of a layer's rows that
#: younger layers may hold before it is folded with them.
STALE_MERGES, YOUNG_PART = 256, 0.5

Pair = tuple[str, str]


def _by_pair(words: DataFrame) -> DataFrame:
    """The words once for each distinct pair in them, as the text ``|l||r|`` that stands in ``toks``, in column ``pair``.

    A pair that a word holds several times is kept where it stands first, which its place in ``toks`` tells; so all of it
    is compiled, where a lambda over the token array would be interpreted.
    """
    a, i = F.col("a"), F.col("i")
    pair = F.concat(F.lit("|"), a[i], F.lit("||"), a[i + 1], F.lit("|"))
    found = pair_occurrences(words, keep=words.columns).select(*words.columns, "i", pair.alias("pair"))
    start = F.expr("substring(toks, 1, instr(toks, pair) - 1)")
    tokens_before = (F.length(start) - F.length(F.replace(start, F.lit("|"), F.lit("")))) / 2
    once = F.expr("locate(pair, toks, instr(toks, pair) + 1) = 0")
    return found.where(once | (tokens_before == i)).drop("i")


def replay(toks: str, merges: Sequence[Pair], done: str = "0") -> Column:
    """The merges from number ``done`` (SQL) on applied in order to the token strings of a column; any number of them,
    as a fold over a list, not a nested expression."""
    if not merges:
        return F.col(toks)
    steps = " ".join(f"{pair_string(*m)}>{merged_string(*m)}" for m in merges)
    return F.expr(f"aggregate(slice(split('{steps}', ' '), 1 + {done}, {len(merges)}), {toks}, "
                  "(t, m) -> replace(t, substring_index(m, '>', 1), substring_index(m, '>', -1)))")


def _any_of(pairs: Sequence[Pair]) -> Column:
    """A filter that Spark pushes down whole (a long ``IN`` would reach the files as its least and greatest value)."""
    return F.expr(" OR ".join(f"pair = '{pair_string(*p)}'" for p in pairs) or "false")


def _written(postings: DataFrame, rows: int) -> DataFrame:
    path = scratch_path(postings.sparkSession, "postings")
    files = max(1, -(-rows // FILE_ROWS))
    placed = postings.repartitionByRange(files, "pair", "word_id") if files > 1 else postings.repartition(1)
    placed.sortWithinPartitions("pair", "word_id").write.option(
        "parquet.page.row.count.limit", str(PAGE_ROWS)).parquet(path)
    return postings.sparkSession.read.schema(postings.schema).parquet(path)


@dataclass(frozen=True)
class Layer:
    """Postings (``rows``) whose words have the first ``version`` merges applied."""

    postings: DataFrame
    rows: int
    version: int


@dataclass(frozen=True)
class WordIndex:
    """Layers of postings and the merges committed so far. The driver holds no rows of them."""

    layers: tuple[Layer, ...]
    merges: tuple[Pair, ...] = field(default=())

    def postings_of(self, pairs: Sequence[Pair]) -> DataFrame:
        """The postings of the wanted pairs as they were written, with their ``version``; the filter reaches the scans."""
        found = None
        for layer in self.layers:
            rows = layer.postings.where(_any_of(pairs)).withColumn("version", F.lit(layer.version))
            found = rows if found is None else found.unionByName(rows)
        return found

    def words_of(self, pairs: Sequence[Pair]) -> DataFrame:
        """``(word_id, toks, freq)`` of all words that hold one of the pairs, each once and up to date."""
        latest = self.postings_of(pairs).groupBy("word_id").agg(
            F.max_by("toks", "version").alias("toks"), F.max("version").alias("version"), F.first("freq").alias("freq"))
        now = latest.select("word_id", replay("toks", self.merges, "version").alias("toks"), "freq")
        return now.where(" OR ".join(f"contains(toks, '{pair_string(*p)}')" for p in pairs) or "false")

    def merged(self, words: DataFrame, pairs: Sequence[Pair]) -> tuple[WordIndex, DataFrame]:
        """The index after committing ``pairs`` in order, and the changed words ``(word_id, before, toks, freq)``.

        ``words``: at least all words that hold one of ``pairs`` (as ``words_of`` gives them), written or cached. A
        merge makes at most two pairs a time it occurs, so the layer has about that many postings a word.
        """
        changed = words.select("word_id", F.col("toks").alias("before"), replay("toks", pairs).alias("toks"),
                               "freq").where("before <> toks")
        postings = _by_pair(changed).where("NOT contains(before, pair)").select("pair", "word_id", "toks", "freq")
        merges = self.merges + tuple(pairs)
        layer = _layer(postings, len(merges), 2 * words.count())
        return replace(self, layers=(*self.layers, layer), merges=merges), changed

    def folded(self, first: int = 0) -> WordIndex:
        """The layers from number ``first`` on as one, with all of their postings that hold, up to date."""
        old, rows = self.layers[first:], None
        for layer in old:
            part = layer.postings.withColumn("toks", replay("toks", self.merges[layer.version:])).where("contains(toks, pair)")
            rows = part if rows is None else rows.unionByName(part)
        return replace(self, layers=(*self.layers[:first], _layer(rows, len(self.merges), sum(x.rows for x in old))))

    def compacted(self, newest: int) -> WordIndex:
        """The ``newest`` layers (but the first) folded, with the older ones that they have outgrown or that are stale."""
        first = max(1, len(self.layers) - newest)
        young = sum(x.rows for x in self.layers[first:])
        stale = [i for i, x in enumerate(self.layers) if len(self.merges) - x.version > STALE_MERGES]
        while first > 0 and (YOUNG_PART * self.layers[first - 1].rows <= young or (stale and stale[0] < first)):
            first -= 1
            young += self.layers[first].rows
        return self.folded(first) if first < len(self.layers) - 1 else self


def _layer(postings: DataFrame, version: int, rows: int) -> Layer:
    """``rows``: at most how many postings, about; the layer knows how many were written."""
    written = _written(postings, rows)
    return Layer(written, written.count(), version)


def build_index(words: DataFrame, rows: int | None = None) -> WordIndex:
    """The index of words ``(word_id, toks, freq)`` with unique ids; ``rows``: about how many postings, if known."""
    postings = _by_pair(words.select("word_id", "toks", "freq")).select("pair", "word_id", "toks", "freq")
    if rows is None:
        rows = words.agg(F.sum(F.length("toks") / 4).cast("long")).first()[0] or 0
    return WordIndex((_layer(postings, 0, rows),))
