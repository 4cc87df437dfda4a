"""A4/A5: exact byte-pair learner in few distributed rounds.

A round finds the K best pairs in learner order (count, then greatest bytes) and how often each token stands beside
them. From these the driver follows one-by-one learning as far as bounds on the counts decide it, also through merges
that overlap (``commits.py``), and the merges it commits are applied together. Driver state is the merge list, K
rows per round and their frequent neighbours.

Two strategies produce the counts (see ``train_bpe``): a one-job recount of the persisted word table
``(toks, freq)`` for small tables; for large ones pair counts that are kept up by changes, and an inverted index from
pairs to words (``word_index.py``), so that a round reads only words that hold one of its pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pairs import merge_pairs
from ..session import ensure_checkpoint_dir, sql_conf
from ..sinks.tables import materialize
from .commits import Candidate, commit_overlapping
from .counts import pair_counts, pair_occurrences, pretoken_counts, top_pairs, word_tokens
from .word_index import build_index

VOCAB_SCHEMA = T.StructType(
    [T.StructField("token_id", T.IntegerType(), False), T.StructField("token", T.BinaryType(), False)]
)
MERGES_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("left", T.BinaryType(), False),
        T.StructField("right", T.BinaryType(), False),
    ]
)


@dataclass
class BpeModel:
    """Vocabulary (index = id) and ranked merges; bounded by the vocabulary size, not by the data."""

    vocab: list[bytes]
    merges: list[tuple[bytes, bytes]]
    specials: list[str] = field(default_factory=list)
    rounds: int = 0

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, t) for i, t in enumerate(self.vocab)], VOCAB_SCHEMA)

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r, l, rr) for r, (l, rr) in enumerate(self.merges)], MERGES_SCHEMA)


def base_vocab(specials: Sequence[str] | None) -> list[bytes]:
    """U5 start: 256 single bytes, then the specials in the given order."""
    vocab = [bytes([i]) for i in range(256)]
    for s in specials or []:
        vocab.append(s.encode("utf-8"))
    return vocab


# One recount round as one SQL statement over the word table's view: analysed once per round (a
# chain of DataFrame calls would be re-analysed step by step, which costs more than the job itself
# on small tables). ``per_nb`` is shuffled once and used twice: for the best pairs and for their neighbours.
_ROUND_SQL = """
WITH occ AS (
  SELECT freq, a, i
  FROM (SELECT freq, split(substring(toks, 2, length(toks) - 2), '\\\\|\\\\|', -1) AS a FROM {view})
  LATERAL VIEW explode(sequence(0, size(a) - 2)) s AS i
),
trip AS (
  SELECT a[i] AS left, a[i + 1] AS right, freq, nb.side AS side, nb.tok AS tok
  FROM occ
  LATERAL VIEW explode(array(
    named_struct('side', 'L', 'tok', CASE WHEN i > 0 THEN a[i - 1] END),
    named_struct('side', 'R', 'tok', CASE WHEN i + 2 < size(a) THEN a[i + 2] END))) t AS nb
),
per_nb AS (SELECT left, right, side, tok, sum(freq) AS c FROM trip GROUP BY left, right, side, tok),
best AS (
  SELECT left AS l, right AS r, sum(c) AS n FROM per_nb WHERE side = 'L' GROUP BY left, right
  ORDER BY n DESC, l DESC, r DESC LIMIT {k}
)
SELECT /*+ BROADCAST(best) */ l, r, n, side, tok, c FROM per_nb JOIN best ON left = l AND right = r
WHERE c >= {floor} OR tok IS NULL
"""


def ranked_candidates(words: DataFrame, k: int, floor: int = 1, view: str | None = None) -> list[Candidate]:
    """One job per round: the k best pairs in learner order, with their neighbours of ``floor`` occurrences or more.

    Every pair occurrence emits its left and its right neighbour (null at a word edge), weighted by the word
    frequency; sums per ``(pair, side, neighbour)`` give both the counts (the left sides: one per occurrence) and the
    neighbours. ``words`` must hold words of at least two tokens. The result has at most ``n / floor`` rows per pair
    and side beside the edges.
    """
    spark = words.sparkSession
    view = view or f"bpe_words_{uuid.uuid4().hex[:12]}"
    words.createOrReplaceTempView(view)
    return _candidates((tuple(r) for r in spark.sql(_ROUND_SQL.format(view=view, k=int(k), floor=int(floor))).collect()))


def _candidates(rows) -> list[Candidate]:
    """Candidates in learner order from rows (left, right, n, side, neighbour, count)."""
    found: dict[tuple[str, str], Candidate] = {}
    for left, right, n, side, tok, c in rows:
        pair = found.setdefault((left, right), Candidate(left, right, int(n), {}, {}))
        if tok is not None:
            (pair.before if side == "L" else pair.after)[tok] = int(c)
    return sorted(found.values(), key=lambda c: (c.n, c.left, c.right), reverse=True)


def neighbours(words: DataFrame, best: list[tuple[str, str, int]], floor: int) -> list[Candidate]:
    """The given best pairs with their neighbours, from words that include all that hold one of them."""
    keys = [f"{l} {r}" for l, r, _ in best]  # a few literals: an in-set test, no join
    a, i = F.col("a"), F.col("i")
    occ = pair_occurrences(words).select("freq", "a", "i", F.concat_ws(" ", "left", "right").alias("key")).where(
        F.col("key").isin(keys))
    beside = F.array(F.struct(F.lit("L").alias("side"), F.when(i > 0, a[i - 1]).alias("tok")),
                     F.struct(F.lit("R").alias("side"), F.when(i + 2 < F.size(a), a[i + 2]).alias("tok")))
    sums = occ.select("key", "freq", F.explode(beside).alias("nb")).groupBy("key", "nb.side", "nb.tok").agg(
        F.sum("freq").alias("c")).where((F.col("c") >= floor) & F.col("tok").isNotNull())
    counts = {(l, r): n for l, r, n in best}
    rows = [(*r.key.split(" "), r.side, r.tok, r.c) for r in sums.collect()]
    return _candidates([(l, r, n, None, None, 0) for l, r, n in best]
                       + [(l, r, counts[l, r], side, tok, c) for l, r, side, tok, c in rows])


def pair_deltas(changed: DataFrame) -> DataFrame:
    """Count changes ``(left, right, dn)`` of changed words ``(before, toks, freq)``: -freq for the pairs before, +freq after."""
    lost = changed.select((-F.col("freq")).alias("d"), F.col("before").alias("toks"))
    now = changed.select(F.col("freq").alias("d"), "toks")
    occurrences = pair_occurrences(lost.unionByName(now), keep=("d",))
    return occurrences.groupBy("left", "right").agg(F.sum("d").alias("dn")).where("dn <> 0")


def train_bpe(
    docs: DataFrame,
    vocab_size: int,
    specials: Sequence[str] | None = None,
    text_col: str = "text",
    candidates: int = 32,
    checkpoint_every: int = 8,
    partitions: int | None = None,
    one_by_one: bool = False,
    incremental: bool | None = None,
) -> BpeModel:
    """A4: learn merges until ``vocab_size`` ids exist or no pair remains.

    Two exact strategies, same merges:
    * incremental: keep the pair-count table, update it with the count changes of the words that a round
      rewrote, and find those words by an inverted index; work per round follows the rewritten words, at
      the price of a few small jobs per round;
    * recount: one job per round that recounts all pairs together with their neighbours.
    ``incremental=None`` picks by size: recount while the word table holds at most
    ``RECOUNT_MAX_PAIRS`` pair occurrences (job latency dominates) or at most ``RECOUNT_MAX_MERGES``
    merges are wanted (they take a few rounds, which write next to nothing), incremental beyond.
    ``one_by_one=True`` commits a single merge per round (the reference's order, for checks).

    The loop runs with adaptive execution off: its jobs have fixed shapes (partial aggregates of
    persisted tables, k-row results), so runtime re-planning has nothing to gain and costs a
    re-plan per stage in every round. Hot pairs are combined map-side by the partial aggregate.
    """
    with sql_conf(docs.sparkSession, spark__sql__adaptive__enabled="false"):
        return _train(docs, vocab_size, specials, text_col, candidates, checkpoint_every, partitions, one_by_one, incremental)


# Pair occurrences (sum over distinct words of their pair count) up to which a round recounts all.
RECOUNT_MAX_PAIRS = 20_000_000
# Merges up to which a round recounts all at any size: an index of all pairs is many times the words, and few rounds use it.
RECOUNT_MAX_MERGES = 64
# Distinct words per partition of the persisted word table.
WORDS_PER_PARTITION = 250_000


def _train(docs, vocab_size, specials, text_col, candidates, checkpoint_every, partitions, one_by_one, incremental):
    spark = docs.sparkSession
    specials = list(specials or [])
    vocab = base_vocab(specials)
    merges: list[tuple[bytes, bytes]] = []
    if len(vocab) >= vocab_size:
        return BpeModel(vocab, merges, specials)
    ensure_checkpoint_dir(spark)
    counted = word_tokens(pretoken_counts(docs, specials, text_col)).persist()
    stats = counted.agg(F.count(F.lit(1)).alias("w"), F.sum(F.length("toks") / 4 - 1).cast("long").alias("p")).first()
    n_words, occurrences = int(stats.w or 0), int(stats.p or 0)
    if partitions is None:
        # ~WORDS_PER_PARTITION distinct words per task, at least the cluster's parallelism and at most
        # the configured shuffle partitions; narrowing is a coalesce (no shuffle).
        upper = int(spark.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(spark.sparkContext.defaultParallelism, -(-n_words // WORDS_PER_PARTITION))
        partitions = max(1, min(partitions, upper))
    words = counted.coalesce(partitions).persist() if counted.rdd.getNumPartitions() > partitions else counted
    if incremental is None:
        incremental = occurrences > RECOUNT_MAX_PAIRS and vocab_size - len(vocab) > RECOUNT_MAX_MERGES
    with sql_conf(spark, spark__sql__shuffle__partitions=str(partitions)):
        return _rounds(spark, words, counted, vocab, merges, specials, vocab_size, candidates, checkpoint_every,
                       one_by_one, incremental)


PAIR_KEYS = ["left", "right"]


def _current_counts(base: DataFrame, acc: DataFrame) -> DataFrame:
    """Pair counts = ``base`` + accumulated changes ``acc``.

    Both tables are hash-partitioned on the pair with the same number of partitions (the loop pins
    it), so this full outer join (a hash join built on the small ``acc``) shuffles neither side.
    """
    j = base.join(acc.hint("shuffle_hash"), PAIR_KEYS, "full_outer")
    n = F.coalesce(F.col("n"), F.lit(0)) + F.coalesce(F.col("dn"), F.lit(0))
    return j.select("left", "right", n.alias("n")).filter(F.col("n") > 0)


def _rounds(spark, words, counted, vocab, merges, specials, vocab_size, candidates, checkpoint_every, one_by_one,
            incremental):
    run = _Indexed(spark, words, checkpoint_every) if incremental else _Recounted(spark, words, checkpoint_every)
    if counted is not words and incremental:
        counted.unpersist()
    existing = {t.hex().upper() for t in vocab}
    rounds, floor = 0, 1
    while len(vocab) < vocab_size:
        budget = vocab_size - len(vocab)
        k = 1 if one_by_one else candidates
        best = run.candidates(k, floor)
        if counted is not words:
            counted.unpersist()  # the words made from it are cached by now
        if not best:
            break
        committed = commit_overlapping(best, k, floor, existing, 1 if one_by_one else budget)
        floor = max(1, best[-1].n // FLOOR_PART)
        for left, right in committed:
            lb, rb = bytes.fromhex(left), bytes.fromhex(right)
            merges.append((lb, rb))
            vocab.append(lb + rb)
            existing.add(left + right)
        rounds += 1
        if len(vocab) < vocab_size:
            run.commit(committed)
    run.close()
    counted.unpersist()
    return BpeModel(vocab, merges, specials, rounds)


# Neighbours that count less than the least candidate of the round before divided by this are not listed.
FLOOR_PART = 256


class _Recounted:
    """The cached word table, rewritten by every round."""

    def __init__(self, spark, words: DataFrame, checkpoint_every: int):
        self.spark, self.words, self.every, self.old, self.rounds = spark, words, checkpoint_every, [], 0
        self.view = f"bpe_words_{uuid.uuid4().hex[:12]}"

    def candidates(self, k: int, floor: int) -> list[Candidate]:
        best = ranked_candidates(self.words, k, floor, self.view)
        for df in self.old:  # read until the words made from them were cached
            df.unpersist()
        self.old = []
        return best

    def commit(self, pairs: list[tuple[str, str]]) -> None:
        """The merges applied as a chain of ``replace`` calls in one projection; words of one token left out."""
        nxt = self.words.select(merge_pairs(F.col("toks"), pairs).alias("toks"), "freq").where(F.instr("toks", "||") > 0)
        self.rounds += 1
        if self.rounds % self.every == 0:  # a reliable checkpoint in the shared folder cuts the lineage
            nxt = nxt.checkpoint(eager=True)
        self.old.append(self.words)
        self.words = nxt.persist()

    def close(self) -> None:
        self.spark.catalog.dropTempView(self.view)
        for df in [*self.old, self.words]:
            df.unpersist()


class _Indexed:
    """Pair counts as a written base and its changes, both hash-partitioned on the pair, and the inverted index."""

    def __init__(self, spark, words: DataFrame, fold_every: int):
        self.spark, self.every, self.rounds, self.hits = spark, fold_every, 0, None
        numbered = materialize(words.select(F.monotonically_increasing_id().alias("word_id"), "toks", "freq"), "words")
        words.unpersist()
        self.index = build_index(numbered)
        self.base = materialize(pair_counts(numbered), "pair-counts")
        self.changes: list[DataFrame] = []  # a written table a round

    def _counts(self) -> DataFrame:
        """Current counts; one sum per pair over the base and the changes since it was written."""
        rows = self.base
        for delta in self.changes:
            rows = rows.unionByName(delta.withColumnRenamed("dn", "n"))
        if self.changes:
            rows = rows.groupBy("left", "right").agg(F.sum("n").alias("n")).where("n > 0")
        return rows

    def candidates(self, k: int, floor: int) -> list[Candidate]:
        best = [(r.left, r.right, int(r.n)) for r in top_pairs(self._counts(), k).collect()]
        if not best:
            return []
        self.hits = materialize(self.index.words_of([(l, r) for l, r, _ in best]), "touched")
        if k == 1:
            return [Candidate(l, r, n) for l, r, n in best]
        return neighbours(self.hits, best, floor)

    def commit(self, pairs: list[tuple[str, str]]) -> None:
        self.index, changed = self.index.merged(self.hits, pairs)
        self.changes.append(materialize(pair_deltas(changed), "changes"))
        self.rounds += 1
        if self.rounds % self.every == 0:
            self.index = self.index.compacted(self.every)
            self.base, self.changes = materialize(self._counts(), "pair-counts"), []

    def close(self) -> None:
        pass
