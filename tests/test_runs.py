import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tokenyard.operators.runs import long_series, run_progress, run_summary, runs_without_rows, series_extent


def _metrics(spark, n_runs=3, n=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for r in range(n_runs):
        el, tok = 0.0, 0
        for s in sorted(rng.sample(range(1, 500), n)):
            el += rng.choice([0.0, 0.5, 1.0, 2.0])
            tok = s * 1000
            val = rng.random() * 5 if rng.random() < 0.3 else None
            rows.append((f"run{r}", s, el, tok, rng.random() * 5, val, 1e-3))
    return spark.createDataFrame(
        rows, "run_name string, step long, elapsed_seconds double, tokens_seen long, train_loss double, val_loss double, learning_rate double"
    )


def test_run_progress_two_levels_equal_plain_window(spark):
    m = _metrics(spark)
    w = Window.partitionBy("run_name").orderBy("step")
    dt = F.col("elapsed_seconds") - F.lag("elapsed_seconds").over(w)
    plain = m.select(
        "run_name",
        "step",
        F.when(dt > 0, (F.col("tokens_seen") - F.lag("tokens_seen").over(w)) / dt).alias("tokens_per_sec"),
        F.min("val_loss").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("best_val_loss"),
    )
    got = run_progress(m, chunk=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_summary_extent_series(spark):
    m = _metrics(spark, n_runs=2, n=20)
    s = {r.run_name: r for r in run_summary(m).collect()}
    rows = [r for r in m.collect() if r.run_name == "run0"]
    last = max(rows, key=lambda r: r.step)
    assert s["run0"].final_train_loss == last.train_loss
    vals = [r for r in rows if r.val_loss is not None]
    assert s["run0"].final_val_loss == max(vals, key=lambda r: r.step).val_loss
    ls = long_series(m)
    assert ls.count() == len([r for r in m.collect()]) + m.filter("val_loss is not null").count()
    one = spark.createDataFrame([("r", 5, 1.0)], "run_name string, step long, loss double")
    e = series_extent(one).first()
    assert (e.x_min, e.x_max, e.y_min, e.y_max) == (5, 6, 1.0, 2.0)


def test_runs_without_rows(spark):
    idx = spark.createDataFrame([("a", 1), ("b", 5), ("c", 1)], "run_name string, ts long")
    rows = spark.createDataFrame([("a", 3), ("b", 2)], "run_name string, ts long")
    got = sorted(r.run_name for r in runs_without_rows(idx, rows, registered_col="ts", logged_col="ts").collect())
    assert got == ["b", "c"]
    assert sorted(r.run_name for r in runs_without_rows(idx, rows).collect()) == ["c"]


def test_audit_learning_rate_one_step_behind(spark):
    from tokenyard.operators.runs import audit_learning_rate

    # A run with lr 1e-3, min 1e-4, warm-up 100, 10,000 iterations logs 0.00099 at step 100.
    m = spark.createDataFrame([(100, 0.00099), (101, 0.00099)], "step long, learning_rate double")
    got = {r.step: r.lr_ok for r in audit_learning_rate(m, 1e-3, 1e-4, 100, 10000).collect()}
    assert got == {100: True, 101: False}


def test_progress_chunk_grows_with_span(spark):
    from tokenyard.operators.runs import MAX_CHUNKS_PER_RUN, progress_chunk

    small = spark.createDataFrame([("a", 1), ("a", 5000)], "run_name string, step long")
    assert progress_chunk(small) == 4096
    wide = spark.createDataFrame([("a", 0), ("a", 4096 * MAX_CHUNKS_PER_RUN * 3)], "run_name string, step long")
    c = progress_chunk(wide)
    assert (4096 * MAX_CHUNKS_PER_RUN * 3) // c < MAX_CHUNKS_PER_RUN and c % 4096 == 0


def test_minmax_project_salted_equals_broadcast(spark):
    import tokenyard.operators.runs as R

    pts = spark.createDataFrame(
        [("hot", s, "train_loss", 1.0 + (s % 7)) for s in range(200)] + [("cold", 3, "val_loss", 2.0)],
        "run_name string, step long, series string, loss double",
    )
    ext = R.series_extent(pts)
    a = sorted(map(tuple, R.minmax_project(pts, ext, 2).collect()))
    old = R.BROADCAST_SUMMARY_LIMIT
    R.BROADCAST_SUMMARY_LIMIT = 0  # force the salted join
    try:
        b = sorted(map(tuple, R.minmax_project(pts, ext, 2).collect()))
    finally:
        R.BROADCAST_SUMMARY_LIMIT = old
    assert a == b and len(a) == 201
