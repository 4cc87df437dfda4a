"""A7-A9 losses, W3 nucleus cut-off, T6 weighted draw, J5 embedding lookup over tables of scores.

Two layouts are supported: array form (one row per example, ``ARRAY<DOUBLE>`` of class scores) for
per-row math without any shuffle, and long form ``(row_id, class_id, logit)`` for ranking within a
row, where one shuffle on ``row_id`` brings a row's classes together (a group is one vocabulary).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform01
from ..functions.vecmath import token_loss


def long_scores(df: DataFrame, row_col: str, arr_col: str, value_name: str = "logit") -> DataFrame:
    """Array form -> long form ``(row_id, class_id, <value_name>)`` (narrow)."""
    return df.select(
        F.col(row_col).alias("row_id"),
        F.posexplode(F.transform(arr_col, lambda x: x.cast("double"))).alias("class_id", value_name),
    )


def row_losses(df: DataFrame, logits_col: str, target_col: str) -> DataFrame:
    """A7 per row (array form): adds ``loss = logsumexp - logit[target]`` (no shuffle)."""
    return df.withColumn("loss", token_loss(F.col(logits_col), F.col(target_col)))


def cross_entropy(df: DataFrame, logits_col: str, target_col: str, by: list[str] | None = None) -> DataFrame:
    """Mean cross-entropy, overall or per group (partial + final aggregate)."""
    losses = row_losses(df, logits_col, target_col)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss")]
    return losses.groupBy(*(by or [])).agg(*aggs)


def estimate_loss(batch_losses: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A8 + A9: mean over batches of the batch means, and its perplexity ``exp(mean)``."""
    per_batch = batch_losses.groupBy(batch_col).agg(F.avg("loss").alias("batch_loss"))
    return per_batch.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.avg("batch_loss").alias("loss"),
    ).withColumn("perplexity", F.exp("loss"))


def check_sampling(temperature: float, top_p: float) -> None:
    """G20."""
    if temperature <= 0:
        raise ValueError(f"temperature {temperature} is not positive")
    if not 0 < top_p <= 1:
        raise ValueError(f"top_p {top_p} is outside (0, 1]")


def nucleus_of(logits: Column, temperature: float = 1.0, top_p: float = 1.0) -> Column:
    """W3/T4 within a row: an array of scores -> ``ARRAY<STRUCT<class_id, rank, p, q>>`` of the kept classes by rank.

    The same as ``nucleus`` without an exchange: the row's classes are sorted in place, one pass over them adds up the
    mass until it reaches ``top_p``, and what came before is the cut. A null or empty array gives a null or empty one.
    """
    check_sampling(temperature, top_p)
    z = F.transform(logits, lambda x: x.cast("double") / F.lit(float(temperature)))

    def ranked(z):
        top = F.array_max(z)
        e = F.transform(z, lambda x: F.exp(x - top))
        return _with(e, lambda e: _with(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.array_sort(
            F.transform(e, lambda x, i: F.struct((-x / total).alias("less"), i.alias("class_id"))))))

    def cut(sorted_):
        start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("n"))
        end = F.aggregate(sorted_, start, lambda acc, c: F.when(
            acc["mass"] < F.lit(float(top_p)), F.struct((acc["mass"] - c["less"]).alias("mass"), (acc["n"] + 1).alias("n"))).otherwise(acc))
        return _with(end, lambda end: F.transform(F.slice(sorted_, F.lit(1), end["n"]), lambda c, i: F.struct(
            c["class_id"].alias("class_id"), (i + 1).alias("rank"), (-c["less"]).alias("p"), (-c["less"] / end["mass"]).alias("q"))))

    return _with(z, lambda z: _with(ranked(z), cut))


def draw_of(kept: Column, row_id: Column, seed: int) -> Column:
    """T6 within a row: the class that a repeatable uniform of the row draws from ``nucleus_of``'s array; null from none."""
    def pick(u):
        start = F.struct(F.lit(0.0).alias("mass"), F.lit(None).cast("int").alias("class_id"))
        found = F.aggregate(kept, start, lambda acc, c: F.when(acc["class_id"].isNotNull() & (acc["mass"] > u), acc).otherwise(
            F.struct((acc["mass"] + c["q"]).alias("mass"), c["class_id"].cast("int").alias("class_id"))))
        return found["class_id"]

    return _with(uniform01(row_id, seed), pick)


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def nucleus(long_df: DataFrame, temperature: float = 1.0, top_p: float = 1.0) -> DataFrame:
    """Classes kept by top-p per row, ``(row_id, class_id, rank, p, q)``.

    ``p`` is the tempered softmax, ``rank`` the 1-based position in descending ``p`` (ties by class),
    a class is kept while the mass strictly before it is below ``top_p`` (G19), and ``q`` is ``p``
    renormalised over the kept classes.
    """
    check_sampling(temperature, top_p)
    row = Window.partitionBy("row_id")
    ordered = row.orderBy(F.desc("p"), F.asc("class_id"))
    z = F.col("logit") / F.lit(float(temperature))
    scored = long_df.withColumn("_z", z).withColumn("_e", F.exp(F.col("_z") - F.max("_z").over(row)))
    probs = scored.withColumn("p", F.col("_e") / F.sum("_e").over(row))
    ranked = probs.withColumn("rank", F.row_number().over(ordered)).withColumn(
        "_cum", F.sum("p").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    kept = ranked.filter(F.col("_cum") - F.col("p") < F.lit(float(top_p)))
    return kept.withColumn("q", F.col("p") / F.sum("p").over(row)).select("row_id", "class_id", "rank", "p", "q")


def weighted_draw(kept: DataFrame, seed: int) -> DataFrame:
    """One class per row with probability ``q`` (inverse CDF on a repeatable uniform).

    The row's classes are already together after W3's exchange, so this adds no shuffle.
    """
    ordered = Window.partitionBy("row_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = kept.withColumn("_cq", F.sum("q").over(ordered)).withColumn("_u", uniform01(F.col("row_id"), seed))
    return cum.groupBy("row_id").agg(
        F.coalesce(
            F.min_by("class_id", F.when(F.col("_cq") > F.col("_u"), F.col("rank"))),
            F.max_by("class_id", F.col("rank")),
        ).alias("class_id")
    )


def embed_lookup(token_counts: DataFrame, emb: DataFrame, id_col: str = "token_id", emb_id: str = "vec_id",
                 emb_col: str = "embedding") -> DataFrame:
    """Attach the vector of each token id; an id without one is an error.

    Give ids aggregated (one row per id and group), as here: then no id is hot. Spark broadcasts the vectors if
    their bytes allow.
    """
    side = emb.select(F.col(emb_id).alias(id_col), F.col(emb_col).alias("vec"))
    joined = token_counts.join(side, id_col, "left")
    missing = F.raise_error(F.lit("token id without an embedding")).cast(side.schema["vec"].dataType)
    return joined.withColumn("vec", F.coalesce("vec", missing))


# Tasks that the vectors are spread over for each block of W, where W is too large to be broadcast.
PROJECT_SALTS = 32


def linear_project_table(rows: DataFrame, weights: DataFrame, vec_col: str, keys: list[str] | tuple[str, ...],
                         block_rows: int = 1024) -> DataFrame:
    """F14 with W as a table ``(out_id, w ARRAY<DOUBLE>)`` of any number of rows: ``(*keys, out_id, score)``.

    W goes in blocks of about ``block_rows`` rows; every vector meets every block in an equi-join on the block and a salt
    from the row's keys, so that a W of one block is still no single join key.
    """
    n_blocks = weights.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int")).scalar()
    w = weights.select("out_id", "w", n_blocks.alias("_n")).groupBy(
        F.pmod(F.xxhash64("out_id"), F.col("_n")).cast("int").alias("_block")).agg(
        F.collect_list(F.struct("out_id", "w")).alias("_w")).withColumn("_salt", F.explode(F.sequence(
            F.lit(0).cast("long"), F.lit(PROJECT_SALTS - 1).cast("long"))))
    x = rows.select(*keys, F.transform(vec_col, lambda v: v.cast("double")).alias("_x"), n_blocks.alias("_n"))
    x = x.select(*keys, "_x", F.pmod(F.xxhash64(*keys), F.lit(PROJECT_SALTS)).alias("_salt"),
                 F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_block"))
    met = x.join(w, ["_block", "_salt"]).select(*keys, "_x", F.explode("_w").alias("_o"))
    dot = F.aggregate(F.zip_with("_x", F.col("_o.w"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    return met.select(*keys, F.col("_o.out_id").alias("out_id"), dot.alias("score"))
