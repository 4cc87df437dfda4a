"""Training-run metrics: A10 summary, A11 extents, F18 projection, U4 long series, W5 progress, J7.

Metrics rows follow the run-log schema ``(run_name, step, elapsed_seconds, tokens_seen, train_loss,
val_loss, learning_rate)``. Per-run aggregates are partial + final hash aggregates (a run with a
third of all rows is combined map-side). Running values (W5) use two levels so that no task has to
sort a whole run: steps are cut into chunks of ``chunk`` steps, running values are taken inside a
``(run, chunk)`` partition, and the carry from earlier chunks comes from a per-chunk summary table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Largest per-chunk / per-run summary we broadcast back.
BROADCAST_SUMMARY_LIMIT = 1_000_000
# Tasks that a run's rows are spread over in a join with a table of runs.
RUN_SALTS = 32


def run_summary(metrics: DataFrame, run_col: str = "run_name") -> DataFrame:
    """A10: first/last step, final train loss, final and best validation loss, elapsed, tokens/s."""
    val_step = F.when(F.col("val_loss").isNotNull(), F.col("step"))
    return metrics.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.max_by("train_loss", "step").alias("final_train_loss"),
        F.max_by("val_loss", val_step).alias("final_val_loss"),
        F.min("val_loss").alias("best_val_loss"),
        F.max("elapsed_seconds").alias("elapsed_seconds"),
        F.when(F.max("elapsed_seconds") > 0, F.max("tokens_seen") / F.max("elapsed_seconds")).alias("tokens_per_sec"),
    )


def net_throughput(metrics: DataFrame, run_col: str = "run_name") -> DataFrame:
    """Tokens per second between a run's first and last row, so tokens from before a resume do not count."""
    tokens = F.max("tokens_seen") - F.min("tokens_seen")
    seconds = F.max("elapsed_seconds") - F.min("elapsed_seconds")
    return metrics.groupBy(run_col).agg(F.when(seconds > 0, tokens / seconds).alias("net_tokens_per_sec"))


def long_series(metrics: DataFrame, run_col: str = "run_name") -> DataFrame:
    """U4 + P7: train and validation losses as one list of points; null losses dropped."""
    return metrics.unpivot(
        [run_col, "step", "elapsed_seconds"], ["train_loss", "val_loss"], "series", "loss"
    ).filter(F.col("loss").isNotNull())


def series_extent(points: DataFrame, x_col: str = "step", run_col: str = "run_name") -> DataFrame:
    """min/max of x and loss over both series; a degenerate range is widened by one."""
    ext = points.groupBy(run_col).agg(
        F.min(x_col).alias("x_min"), F.max(x_col).alias("x_max"), F.min("loss").alias("y_min"), F.max("loss").alias("y_max")
    )
    return ext.select(
        run_col,
        "x_min",
        F.when(F.col("x_min") == F.col("x_max"), F.col("x_min") + 1).otherwise(F.col("x_max")).alias("x_max"),
        "y_min",
        F.when(F.col("y_min") == F.col("y_max"), F.col("y_min") + 1).otherwise(F.col("y_max")).alias("y_max"),
    )


# Salt buckets for the extents join when the extents are too many to broadcast.
PROJECT_SALTS = 32


def minmax_project(points: DataFrame, extents: DataFrame, n_runs: int, x_col: str = "step", run_col: str = "run_name",
                   width: int = 900, height: int = 520, margins=(80, 30, 40, 70)) -> DataFrame:
    """map points into a pixel box (y grows downwards).

    The per-run extents are broadcast below a checked size. Beyond it the join is salted: points get
    a salt from a hash of their step and each extents row is repeated once per salt, so a run with
    a third of all points is spread over ``PROJECT_SALTS`` join partitions instead of one.
    """
    left, right, top, bottom = margins
    pw, ph = width - left - right, height - top - bottom
    if n_runs <= BROADCAST_SUMMARY_LIMIT:
        j = points.join(F.broadcast(extents), run_col)
    else:
        salted = points.withColumn("_salt", F.pmod(F.xxhash64(F.col(x_col)), F.lit(PROJECT_SALTS)))
        spread = extents.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PROJECT_SALTS - 1).cast("long"))))
        j = salted.join(spread, [run_col, "_salt"])
    px = F.lit(left) + (F.col(x_col) - F.col("x_min")) / (F.col("x_max") - F.col("x_min")) * F.lit(pw)
    py = F.lit(top) + (F.col("y_max") - F.col("loss")) / (F.col("y_max") - F.col("y_min")) * F.lit(ph)
    return j.select(run_col, "series", x_col, px.alias("px"), py.alias("py"))


# Chunks per run kept by run_progress's carry window (rows of the per-chunk summary per run).
MAX_CHUNKS_PER_RUN = 1 << 20


def progress_chunk(metrics: DataFrame, run_col: str = "run_name", floor: int = 4096) -> int:
    """Steps per chunk: at least ``floor``, and wide enough that the widest run has at most
    MAX_CHUNKS_PER_RUN chunks (so neither level sorts more than about a million rows per group)."""
    span = metrics.groupBy(run_col).agg((F.max("step") - F.min("step")).alias("s")).agg(F.max("s")).first()[0] or 0
    chunk = floor
    while span // chunk >= MAX_CHUNKS_PER_RUN:
        chunk *= 2
    return chunk


def run_progress(metrics: DataFrame, run_col: str = "run_name", chunk: int | None = None) -> DataFrame:
    """Per row, tokens/s since the previous row of the run and the best validation loss so far.

    Two levels (see module doc). ``step`` must be unique within a run. ``chunk`` (steps per chunk)
    defaults to ``progress_chunk``: a run holding a third of all rows is cut into at most about a
    million chunks of at most about a million rows each.
    """
    if chunk is None:
        chunk = progress_chunk(metrics, run_col)
    m = metrics.select(run_col, "step", "elapsed_seconds", "tokens_seen", "val_loss").withColumn(
        "_chunk", F.floor(F.col("step") / F.lit(chunk)).cast("long")
    )
    in_chunk = Window.partitionBy(run_col, "_chunk").orderBy("step")
    local = (
        m.withColumn("_prev_el", F.lag("elapsed_seconds").over(in_chunk))
        .withColumn("_prev_tok", F.lag("tokens_seen").over(in_chunk))
        .withColumn("_best_local", F.min("val_loss").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # Per (run, chunk): last row and best loss. Carry = values from all earlier chunks of the run.
    summary = m.groupBy(run_col, "_chunk").agg(
        F.max_by(F.struct("elapsed_seconds", "tokens_seen"), "step").alias("_last"),
        F.min("val_loss").alias("_best"),
    )
    earlier = Window.partitionBy(run_col).orderBy("_chunk")
    carry = summary.select(
        run_col,
        "_chunk",
        F.lag("_last").over(earlier).alias("_carry_last"),
        F.min("_best").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_best"),
    )
    j = local.join(carry, [run_col, "_chunk"])
    prev_el = F.coalesce(F.col("_prev_el"), F.col("_carry_last.elapsed_seconds"))
    prev_tok = F.coalesce(F.col("_prev_tok"), F.col("_carry_last.tokens_seen"))
    dt = F.col("elapsed_seconds") - prev_el
    return j.select(
        run_col,
        "step",
        F.when(dt > 0, (F.col("tokens_seen") - prev_tok) / dt).alias("tokens_per_sec"),
        F.least(F.col("_best_local"), F.col("_carry_best")).alias("best_val_loss"),
    )


def runs_without_rows(index: DataFrame, metrics: DataFrame, run_col: str = "run_name",
                      registered_col: str | None = None, logged_col: str | None = None) -> DataFrame:
    """Runs registered in the index that have no metrics rows (left anti join).

    With ``registered_col``/``logged_col`` a run only counts as logged when it has a row after its
    (latest) registration. Both sides are first reduced to one row per run (partial aggregates), so
    a run with a huge number of rows never lands whole in one join task.
    """
    if registered_col is None:
        return index.select(run_col).distinct().join(metrics.select(run_col).distinct(), run_col, "left_anti")
    idx = index.groupBy(run_col).agg(F.max(registered_col).alias("_reg"))
    lg = metrics.groupBy(run_col).agg(F.max(logged_col).alias("_last"))
    cond = (idx[run_col] == lg[run_col]) & (lg["_last"] > idx["_reg"])
    return idx.join(lg, cond, "left_anti").select(run_col)


def audit_learning_rate(metrics: DataFrame, a_max: float, a_min: float, warmup: int, cycle: int,
                        rel_tol: float = 1e-9) -> DataFrame:
    """G21 via F12: a row logged at ``step`` carries the rate of iteration ``step - 1``.

    Adds ``expected_lr`` and ``lr_ok`` (relative tolerance) to every metrics row (narrow).
    """
    from ..functions.vecmath import lr_schedule

    expected = lr_schedule(F.col("step") - 1, a_max, a_min, warmup, cycle)
    return metrics.withColumn("expected_lr", expected).withColumn(
        "lr_ok", F.abs(F.col("learning_rate") - F.col("expected_lr")) <= F.lit(rel_tol) * F.abs(F.col("expected_lr"))
    )


def runs_join(index: DataFrame, metrics: DataFrame, config: DataFrame | None = None, run_col: str = "run_name") -> DataFrame:
    """Metrics rows with their run's index entry (and parsed configuration when given).

    The index and configuration hold one row per run. They are joined to the (large) metrics side on the run name, so
    Spark broadcasts them when their size estimate is small, and on a salt from the step, so that in a shuffle a run
    with a third of all rows is spread over RUN_SALTS tasks.
    """
    def spread(side: DataFrame) -> DataFrame:
        return side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(RUN_SALTS - 1).cast("long"))))

    out = metrics.withColumn("_salt", F.pmod(F.xxhash64("step"), F.lit(RUN_SALTS)))
    out = out.join(spread(index.drop("configuration")), [run_col, "_salt"])
    if config is not None:
        out = out.join(spread(config.drop("started_at")), [run_col, "_salt"], "left")
    return out.drop("_salt")
