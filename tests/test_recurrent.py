from __future__ import annotations

import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.plans.recurrent import Adam, Recurrent, fit_epochs

LENGTH, INPUTS, CLASSES = 5, 3, 3


def windows(n=90):
    maker = np.random.default_rng(2)
    x = maker.normal(2.0, 3.0, (n, LENGTH * INPUTS))
    return x, (x[:, -1] > 2).astype(int) + (x[:, 0] > 4)


def frame(spark, x, y):
    rows = [([float(v) for v in a], int(b), i) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "x array<double>, y int, key long")


def fresh():
    return Recurrent.fresh(LENGTH, [2.0] * INPUTS, [3.0] * INPUTS, 4, CLASSES, 1)


def test_gradient_is_the_slope_of_the_loss():
    x, y = windows(7)
    net = fresh()
    gradient, loss = net.gradient(x, y)
    assert loss == pytest.approx(-np.log(net._forward(x)[0][np.arange(7), y]).sum())
    weights = net.weights()
    for place in range(0, len(weights), 7):
        moved = weights.copy()
        losses = []
        for step in (1e-5, -1e-5):
            moved[place] = weights[place] + step
            losses.append(net.with_weights(moved).gradient(x, y)[1])
        assert gradient[place] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-6)


def test_the_number_of_tasks_does_not_matter(spark):
    x, y = windows()
    rows = frame(spark, x, y)
    one, four = (fit_epochs(rows, fresh(), epochs=3, batch_rows=20, rate=0.01, tasks=n) for n in (1, 4))
    for (a, loss_a), (b, loss_b) in zip(one, four, strict=True):
        np.testing.assert_allclose(a.weights(), b.weights(), rtol=1e-9, atol=1e-12)
        assert loss_a == pytest.approx(loss_b)
    assert one[-1][1] < one[0][1]

    # The same steps without Spark.
    numbered = rows.select("key", F.pmod(F.xxhash64("key"), F.lit(5)).alias("b")).collect()
    batch = np.array([r.b for r in sorted(numbered, key=lambda r: r.key)])
    net, weights = fresh(), fresh().weights()
    adam = Adam(np.zeros(len(weights)), np.zeros(len(weights)))
    for _ in range(3):
        for step in range(5):
            mine = batch == step
            gradient, _ = net.with_weights(weights).gradient(x[mine], y[mine])
            weights = adam.step(weights, gradient / mine.sum(), 0.01)
    np.testing.assert_allclose(one[-1][0].weights(), weights, rtol=1e-9, atol=1e-12)


def test_save_load_and_shares(spark, tmp_path):
    x, y = windows(30)
    net = fresh()
    net.save(spark, str(tmp_path / "net"))
    again = Recurrent.load(spark, str(tmp_path / "net"))
    assert (again.weights() == net.weights()).all()
    got = np.array([r[0] for r in frame(spark, x, y).select(again.shares(F.col("x"))).collect()])
    np.testing.assert_allclose(got, net._forward(x)[0])
    np.testing.assert_allclose(got.sum(1), 1)


def test_no_rows_leave_the_weights(spark):
    empty = spark.createDataFrame([], "x array<double>, y int, key long")
    (after, _), = fit_epochs(empty, fresh(), epochs=1, batch_rows=20, rate=0.01, tasks=2)
    assert (after.weights() == fresh().weights()).all()


LOST_TASK = """
import os, sys
sys.path[:0] = {path!r}
import numpy as np
from test_recurrent import frame, fresh, windows
from tidewatch.plans import recurrent
from tidewatch.session import get_session
spark = get_session("lost", **{{"spark.master": "local[2,3]", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "2"}})
rows = frame(spark, *windows())
sound = recurrent.fit_epochs(rows, fresh(), epochs=2, batch_rows=20, rate=0.01, tasks=2)
mark, plain = {mark!r}, recurrent._by_mini_batch
def once(batches):
    for number, *rest in plain(batches):
        if number == 2 and not os.path.exists(mark):
            open(mark, "w").close()
            os._exit(1)
        yield number, *rest
recurrent._by_mini_batch = once
again = recurrent.fit_epochs(rows, fresh(), epochs=2, batch_rows=20, rate=0.01, tasks=2)
assert os.path.exists(mark)
for (a, _), (b, _) in zip(sound, again, strict=True):
    np.testing.assert_allclose(a.weights(), b.weights(), rtol=1e-9, atol=1e-12)
print("same weights")
"""


def test_a_lost_worker_changes_nothing(tmp_path):
    code = LOST_TASK.format(path=sys.path, mark=str(tmp_path / "mark"))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert "same weights" in done.stdout, done.stderr[-3000:]
