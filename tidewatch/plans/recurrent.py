"""A recurrent network (one LSTM layer, softmax output) trained in barrier stages.

An epoch is one barrier job over the stored windows. Every task holds the same weights
and a share of each mini-batch. For a step the tasks send the sums of their gradients to
each other (``allGather``) and all make the same update, so the weights never differ
and the result does not depend on the number of tasks but for rounding. Rows are dealt
to mini-batches by a hash and stream through a task in the order of the mini-batches, so
a task holds one mini-batch's share at a time. The weights after each epoch come to the
driver; they are as large as the model. If a task is lost, Spark runs the epoch's stage again
from the weights that the epoch began with.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 2_000
#: Most tasks that exchange gradients; their messages pass through the driver.
MOST_TASKS = 64
FIRST_MOMENT, SECOND_MOMENT, TINY = 0.9, 0.999, 1e-8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Recurrent:
    """Weights and input scaling. ``gates`` maps [input, state, 1] to the four gates."""

    length: int
    mean: np.ndarray
    scale: np.ndarray
    gates: np.ndarray
    output: np.ndarray

    @staticmethod
    def fresh(length: int, mean, scale, hidden: int, classes: int, seed: int) -> Recurrent:
        maker = np.random.default_rng(seed)
        bound = 1 / math.sqrt(hidden)
        inputs = len(mean)
        return Recurrent(
            length, np.asarray(mean, float), np.asarray(scale, float),
            maker.uniform(-bound, bound, (inputs + hidden + 1, 4 * hidden)),
            maker.uniform(-bound, bound, (hidden + 1, classes)),
        )

    def weights(self) -> np.ndarray:
        return np.r_[self.gates.ravel(), self.output.ravel()]

    def with_weights(self, flat: np.ndarray) -> Recurrent:
        cut = self.gates.size
        return Recurrent(self.length, self.mean, self.scale, flat[:cut].reshape(self.gates.shape),
                         flat[cut:].reshape(self.output.shape))

    def _forward(self, flat: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities and last states; ``keep`` collects what the way back needs."""
        x = (flat.reshape(len(flat), self.length, len(self.mean)) - self.mean) / self.scale
        hidden = self.output.shape[0] - 1
        state = cell = np.zeros((len(flat), hidden))
        one = np.ones((len(flat), 1))
        for t in range(self.length):
            joined = np.hstack([x[:, t], state, one])
            z = joined @ self.gates
            i, f, o = (_sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in (0, 1, 3))
            g = np.tanh(z[:, 2 * hidden : 3 * hidden])
            before, cell = cell, f * cell + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            if keep is not None:
                keep.append((joined, i, f, g, o, before, squashed))
        top = np.hstack([state, one])
        z = top @ self.output
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True), top

    def gradient(self, flat: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Sums over rows: gradient of the log loss by all weights, and the loss."""
        kept: list = []
        shares, top = self._forward(flat, kept)
        rows = np.arange(len(y))
        loss = -np.log(np.maximum(shares[rows, y], np.finfo(float).tiny)).sum()
        error = shares
        error[rows, y] -= 1.0
        hidden, inputs = self.output.shape[0] - 1, len(self.mean)
        d_gates = np.zeros_like(self.gates)
        d_state = error @ self.output[:-1].T
        d_cell = np.zeros_like(d_state)
        for joined, i, f, g, o, before, squashed in reversed(kept):
            d_cell = d_cell + d_state * o * (1 - squashed**2)
            d_z = np.hstack([
                d_cell * g * i * (1 - i), d_cell * before * f * (1 - f),
                d_cell * i * (1 - g**2), d_state * squashed * o * (1 - o),
            ])
            d_gates += joined.T @ d_z
            d_state = (d_z @ self.gates.T)[:, inputs : inputs + hidden]
            d_cell = d_cell * f
        return np.r_[d_gates.ravel(), (top.T @ error).ravel()], float(loss)

    def shares(self, features: Column) -> Column:
        """Probabilities of all classes from flat windows."""
        shared = SparkSession.active().sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def score(batch):
            import pandas as pd

            parts = []
            for start in range(0, len(batch), BATCH_ROWS):
                rows = np.stack(batch.iloc[start : start + BATCH_ROWS].to_numpy()).astype(float)
                parts += list(shared.value._forward(rows)[0])
            return pd.Series(parts)

        return score(features)

    def save(self, spark: SparkSession, path: str) -> None:
        named = {k: getattr(self, k).tolist() for k in ("mean", "scale", "gates", "output")}
        text = json.dumps({"length": self.length, **named})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Recurrent:
        named = json.loads(spark.read.text(path).first()[0])
        return Recurrent(named.pop("length"), **{k: np.array(v) for k, v in named.items()})


@dataclass
class Adam:
    """Running moments of the gradients; part of the state between epochs."""

    first: np.ndarray
    second: np.ndarray
    steps: int = 0

    def step(self, weights: np.ndarray, gradient: np.ndarray, rate: float) -> np.ndarray:
        self.steps += 1
        self.first = FIRST_MOMENT * self.first + (1 - FIRST_MOMENT) * gradient
        self.second = SECOND_MOMENT * self.second + (1 - SECOND_MOMENT) * gradient**2
        first = self.first / (1 - FIRST_MOMENT**self.steps)
        second = self.second / (1 - SECOND_MOMENT**self.steps)
        return weights - rate * first / (np.sqrt(second) + TINY)


def _text(numbers: np.ndarray) -> str:
    return base64.b64encode(np.ascontiguousarray(numbers, "<f8").tobytes()).decode()


def _numbers(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<f8")


def _by_mini_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, windows and classes of each mini-batch of a task, in order."""
    current, xs, ys = None, [], []
    for batch in batches:
        number = batch.column("batch").to_numpy()
        if not len(number):
            continue
        y = batch.column("y").to_numpy()
        x = batch.column("x").flatten().to_numpy().reshape(len(number), -1)
        turns = np.r_[0, np.flatnonzero(np.diff(number)) + 1, len(number)]
        for a, b in zip(turns[:-1], turns[1:]):
            if number[a] != current:
                if xs:
                    yield current, np.concatenate(xs), np.concatenate(ys)
                current, xs, ys = number[a], [], []
            xs.append(x[a:b])
            ys.append(y[a:b])
    if xs:
        yield current, np.concatenate(xs), np.concatenate(ys)


def run_epoch(
    rows: DataFrame, model: Recurrent, adam: Adam, steps: int, rate: float, tasks: int
) -> tuple[Recurrent, Adam, float]:
    """One pass over ``rows`` (x, y, batch): new weights, moments, and the mean loss."""
    shared = rows.sparkSession.sparkContext.broadcast((model, adam))

    def train(batches):
        context = BarrierTaskContext.get()
        net, moments = shared.value
        weights = net.weights()
        moments = Adam(moments.first.copy(), moments.second.copy(), moments.steps)
        mine = _by_mini_batch(batches)
        waiting = next(mine, None)
        loss = count = 0.0
        for step in range(steps):
            sums, own_loss, own = np.zeros(len(weights)), 0.0, 0
            if waiting is not None and waiting[0] == step:
                sums, own_loss = net.with_weights(weights).gradient(waiting[1], waiting[2])
                own = len(waiting[2])
                waiting = next(mine, None)
            told = [_numbers(t) for t in context.allGather(_text(np.r_[sums, own_loss, own]))]
            total = np.sum(told, axis=0)
            loss, count = loss + total[-2], count + total[-1]
            if total[-1]:
                weights = moments.step(weights, total[:-2] / total[-1], rate)
        if context.partitionId() == 0:
            state = np.r_[weights, moments.first, moments.second, moments.steps, loss / max(count, 1.0)]
            yield pa.RecordBatch.from_arrays([pa.array([state.astype("<f8").tobytes()], pa.binary())], ["state"])

    dealt = rows.repartition(tasks, "key").sortWithinPartitions("batch").select("x", "y", "batch")
    # One row. The shuffle makes the barrier stage one that Spark can run again.
    found = dealt.mapInArrow(train, "state binary", barrier=True).repartition(1).collect()
    state = np.frombuffer(found[0]["state"], "<f8")
    size = len(model.weights())
    after = Adam(state[size : 2 * size], state[2 * size : 3 * size], int(state[-2]))
    return model.with_weights(state[:size]), after, float(state[-1])


def fit_epochs(
    rows: DataFrame, model: Recurrent, *, epochs: int, batch_rows: int, rate: float, tasks: int | None = None
) -> list[tuple[Recurrent, float]]:
    """Weights and mean loss after each epoch.

    ``rows`` has x (a flat window), y (class index) and key (long). A row's mini-batch
    follows from its key; mini-batches have about ``batch_rows`` rows. No rows leave
    the weights as they are.
    """
    steps = -(-rows.count() // batch_rows)
    if not steps:
        return [(model, math.nan)] * epochs
    numbered = rows.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(steps)))
    context = rows.sparkSession.sparkContext
    tasks = tasks or min(context.defaultParallelism, MOST_TASKS)
    zeros = np.zeros(len(model.weights()))
    adam, found = Adam(zeros, zeros), []
    for _ in range(epochs):
        model, adam, loss = run_epoch(numbered, model, adam, steps, rate, tasks)
        found.append((model, loss))
    return found
