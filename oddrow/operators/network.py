"""Numeric kernel of the autoencoder: forward pass and gradient on one block of rows.

It runs inside Spark tasks. All parameters are one flat vector, trainable ones first, so that
averaging replicas and stepping the optimiser are single vector operations.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import cached_property

import numpy as np

# Library defaults that trained results depend on.
NORM_MOMENTUM, NORM_EPSILON = 0.99, 1e-3
ADAM_BETA1, ADAM_BETA2, ADAM_EPSILON = 0.9, 0.999, 1e-7
SCHEDULE_STEPS, STEP_DECAY_RATE = 1000, 0.9


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


# Each activation with its derivative in terms of input z and output a.
ACTIVATION: dict[str, tuple[Callable, Callable]] = {
    "relu": (lambda z: np.maximum(z, 0), lambda z, a: z > 0),
    "tanh": (np.tanh, lambda z, a: 1 - a * a),
    "sigmoid": (_sigmoid, lambda z, a: a * (1 - a)),
    "linear": (lambda z: z, lambda z, a: np.ones_like(z)),
    "elu": (
        lambda z: np.where(z > 0, z, np.expm1(np.minimum(z, 0))),
        lambda z, a: np.where(z > 0, 1, a + 1),
    ),
    "softplus": (lambda z: np.logaddexp(z, 0), lambda z, a: _sigmoid(z)),
}


def learning_rate(base: float, schedule: str, step: int) -> float:
    """Rate at a global step counted from 0."""
    if schedule == "step_decay":
        return base * STEP_DECAY_RATE ** (step / SCHEDULE_STEPS)
    if schedule == "cosine_annealing":
        return base * 0.5 * (1.0 + np.cos(np.pi * min(step, SCHEDULE_STEPS) / SCHEDULE_STEPS))
    return base


@dataclass(frozen=True)
class Dense:
    name: str
    n_in: int
    n_out: int
    activation: str
    hidden: bool  # hidden layers are normalised, then dropped out


@dataclass(frozen=True)
class Layout:
    """Symmetric encoder and decoder around a bottleneck, with a linear output."""

    input_dim: int
    encoder_layers: tuple[int, ...]
    bottleneck_dim: int
    activation: str = "relu"
    dropout_rate: float = 0.0
    dtype: str = "float32"

    @cached_property
    def layers(self) -> list[Dense]:
        plan = [(f"enc_dense_{i}", n, True) for i, n in enumerate(self.encoder_layers)]
        plan.append(("bottleneck", self.bottleneck_dim, False))
        plan += [(f"dec_dense_{i}", n, True) for i, n in enumerate(self.encoder_layers[::-1])]
        out, width = [], self.input_dim
        for name, units, hidden in plan:
            out.append(Dense(name, width, units, self.activation, hidden))
            width = units
        out.append(Dense("output", width, self.input_dim, "linear", False))
        return out

    @cached_property
    def parameters(self) -> list[tuple[str, str, tuple[int, ...], bool]]:
        """(layer, parameter, shape, trainable), in vector order."""
        learned, running = [], []
        for d in self.layers:
            learned.append((d.name, "kernel", (d.n_in, d.n_out), True))
            learned.append((d.name, "bias", (d.n_out,), True))
            if d.hidden:
                learned.append((d.name, "gamma", (d.n_out,), True))
                learned.append((d.name, "beta", (d.n_out,), True))
                running.append((d.name, "moving_mean", (d.n_out,), False))
                running.append((d.name, "moving_variance", (d.n_out,), False))
        return learned + running

    @cached_property
    def size(self) -> int:
        return sum(int(np.prod(shape)) for _, _, shape, _ in self.parameters)

    @cached_property
    def trainable(self) -> int:
        return sum(int(np.prod(shape)) for _, _, shape, learned in self.parameters if learned)

    @cached_property
    def _places(self) -> list[tuple[tuple[str, str], int, int, tuple[int, ...]]]:
        out, at = [], 0
        for layer, name, shape, _ in self.parameters:
            n = int(np.prod(shape))
            out.append(((layer, name), at, at + n, shape))
            at += n
        return out

    def views(self, vector: np.ndarray) -> dict[tuple[str, str], np.ndarray]:
        """Parameters by layer and name, sharing memory with the vector."""
        return {key: vector[a:b].reshape(shape) for key, a, b, shape in self._places}

    def initial(self, seed: int) -> np.ndarray:
        """Glorot-uniform kernels; unit scales and variances; zeros elsewhere."""
        rng = np.random.default_rng(seed)
        vector = np.zeros(self.size, self.dtype)
        for (_, name), part in self.views(vector).items():
            if name == "kernel":
                limit = np.sqrt(6.0 / sum(part.shape))
                part[:] = rng.uniform(-limit, limit, part.shape)
            elif name in ("gamma", "moving_variance"):
                part[:] = 1.0
        return vector

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Layout:
        raw = json.loads(text)
        return cls(**raw | {"encoder_layers": tuple(raw["encoder_layers"])})


class Forward:
    """Forward pass for scoring: moving statistics, no dropout.

    A layer's normalisation is linear at this point, so it is folded into the next kernel once.
    """

    def __init__(self, layout: Layout, vector: np.ndarray) -> None:
        w = layout.views(vector)
        self.steps: list[tuple[np.ndarray, np.ndarray, str]] = []
        gain = shift = None
        for d in layout.layers:
            kernel, bias = w[d.name, "kernel"], w[d.name, "bias"]
            if gain is not None:
                kernel, bias = gain[:, None] * kernel, bias + shift @ kernel
            self.steps.append((kernel, bias, d.activation))
            gain = None
            if d.hidden:
                gain = w[d.name, "gamma"] / np.sqrt(w[d.name, "moving_variance"] + NORM_EPSILON)
                shift = w[d.name, "beta"] - w[d.name, "moving_mean"] * gain

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        h = rows
        for kernel, bias, activation in self.steps:
            h = h @ kernel
            h += bias
            h = ACTIVATION[activation][0](h)
        return h


def row_errors(rows: np.ndarray, rebuilt: np.ndarray) -> np.ndarray:
    miss = rows - rebuilt
    return np.einsum("ij,ij->i", miss, miss) / miss.shape[1]


def gradient(
    layout: Layout,
    vector: np.ndarray,
    rows: np.ndarray,
    rng: np.random.Generator,
    replicas: int = 1,
) -> tuple[float, np.ndarray]:
    """Training loss of a mini-batch and its gradient; moves the running statistics in place.

    The statistics move on by the steps of all ``replicas``, so that their lag behind the weights
    does not grow with the number of shards.
    """
    momentum = NORM_MOMENTUM**replicas
    w = layout.views(vector)
    grad = np.zeros(layout.size, vector.dtype)
    g_of = layout.views(grad)
    keep = 1.0 - layout.dropout_rate
    tape, h = [], rows
    for d in layout.layers:
        z = h @ w[d.name, "kernel"] + w[d.name, "bias"]
        a = ACTIVATION[d.activation][0](z)
        out, normed, spread, mask = a, None, None, None
        if d.hidden:
            mean = a.mean(0)
            apart = a - mean
            var = np.square(apart).mean(0)
            spread = 1.0 / np.sqrt(var + NORM_EPSILON)
            normed = apart * spread
            out = normed * w[d.name, "gamma"] + w[d.name, "beta"]
            for name, now in (("moving_mean", mean), ("moving_variance", var)):
                w[d.name, name][:] = momentum * w[d.name, name] + (1 - momentum) * now
            if layout.dropout_rate:
                mask = ((rng.random(out.shape) < keep) / keep).astype(out.dtype)
                out = out * mask
        tape.append((d, h, z, a, normed, spread, mask))
        h = out
    miss = h - rows
    loss = float(np.mean(np.square(miss)))
    g = miss * (2.0 / miss.size)
    for d, h_in, z, a, normed, spread, mask in reversed(tape):
        if mask is not None:
            g = g * mask
        if normed is not None:
            g_of[d.name, "gamma"][:] = (g * normed).sum(0)
            g_of[d.name, "beta"][:] = g.sum(0)
            g = g * w[d.name, "gamma"]
            g = spread * (g - g.mean(0) - normed * (g * normed).mean(0))
        g = g * ACTIVATION[d.activation][1](z, a)
        g_of[d.name, "kernel"][:] = h_in.T @ g
        g_of[d.name, "bias"][:] = g.sum(0)
        g = g @ w[d.name, "kernel"].T
    return loss, grad


@dataclass
class BatchSums:
    """What is known of a mini-batch that is read block by block, sweep after sweep.

    A hidden layer's normalisation needs the mean and variance over the whole batch before the
    next layer can be computed, and its gradient needs two sums over the batch before the layer
    below. Every sweep therefore finds one of these: first ``moments`` of the hidden layers from the
    input on, then ``backward`` sums from the output back; the last one finds the gradient.
    """

    rows: int
    moments: list[tuple[np.ndarray, np.ndarray]]
    backward: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def unknown(cls) -> BatchSums:
        return cls(0, [], [])

    @staticmethod
    def sweeps(layout: Layout) -> int:
        return 4 * len(layout.encoder_layers) + 1

    def learn(self, layout: Layout, n: int, sums: np.ndarray) -> None:
        """Take the sums of all blocks of a sweep, but for the last."""
        parts = np.split(sums, 2)
        if len(self.moments) < 2 * len(layout.encoder_layers):
            self.rows = n
            self.moments.append((parts[0], parts[1] / n))
        else:
            self.backward.append((parts[0], parts[1]))


def add_sums(parts: Sequence[tuple[int, np.ndarray]], moments: bool) -> tuple[int, np.ndarray]:
    """Rows and sums of blocks together; ``moments`` are means and squared deviations."""
    n, total = parts[0][0], parts[0][1].copy()
    half = len(total) // 2
    for more, sums in parts[1:]:
        both = n + more
        if moments:
            apart = sums[:half] - total[:half]
            total[half:] += sums[half:] + apart * apart * (n * more / both)
            total[:half] += apart * (more / both)
        else:
            total += sums
        n = both
    return n, total


def block_sums(
    layout: Layout, vector: np.ndarray, rows: np.ndarray, rng: np.random.Generator, known: BatchSums
) -> tuple[float, np.ndarray]:
    """One block's part of the next sums of its batch; in the last sweep of loss and gradient.

    The loss is a sum over cells. Together with the other blocks this is :func:`gradient` of the
    whole batch; ``rng`` must begin anew in every sweep.
    """
    w = layout.views(vector)
    keep = 1.0 - layout.dropout_rate
    tape, h, at = [], rows, 0
    for d in layout.layers:
        z = h @ w[d.name, "kernel"] + w[d.name, "bias"]
        a = ACTIVATION[d.activation][0](z)
        out, normed, spread, mask = a, None, None, None
        if d.hidden:
            if at == len(known.moments):
                mean = a.mean(0, dtype=np.float64)
                apart = a - mean
                return 0.0, np.concatenate([mean, (apart * apart).sum(0)])
            mean, var = known.moments[at]
            at += 1
            spread = (1.0 / np.sqrt(var + NORM_EPSILON)).astype(a.dtype)
            normed = (a - mean.astype(a.dtype)) * spread
            out = normed * w[d.name, "gamma"] + w[d.name, "beta"]
            if layout.dropout_rate:
                mask = ((rng.random(out.shape) < keep) / keep).astype(out.dtype)
                out = out * mask
        tape.append((d, h, z, a, normed, spread, mask))
        h = out
    grad = np.zeros(layout.size, np.float64)
    g_of = layout.views(grad)
    miss = h - rows
    loss = float(np.sum(np.square(miss), dtype=np.float64))
    g = miss * (2.0 / (known.rows * layout.input_dim))
    at = 0
    for d, h_in, z, a, normed, spread, mask in reversed(tape):
        if mask is not None:
            g = g * mask
        if normed is not None:
            if at == len(known.backward):
                found = [(g * normed).sum(0, dtype=np.float64), g.sum(0, dtype=np.float64)]
                return 0.0, np.concatenate(found)
            scaled, plain = known.backward[at]
            at += 1
            g_of[d.name, "gamma"][:] = (g * normed).sum(0, dtype=np.float64)
            g_of[d.name, "beta"][:] = g.sum(0, dtype=np.float64)
            gamma = w[d.name, "gamma"]
            g = g * gamma
            means = [(gamma * s / known.rows).astype(g.dtype) for s in (plain, scaled)]
            g = spread * (g - means[0] - normed * means[1])
        g = g * ACTIVATION[d.activation][1](z, a)
        g_of[d.name, "kernel"][:] = h_in.T @ g
        g_of[d.name, "bias"][:] = g.sum(0, dtype=np.float64)
        g = g @ w[d.name, "kernel"].T
    return loss, grad


def whole_step(
    layout: Layout,
    state: TrainState,
    grad: np.ndarray,
    known: BatchSums,
    base_rate: float,
    schedule: str,
    replicas: int = 1,
) -> None:
    """:func:`train_step` of a batch whose gradient was summed over its blocks, in place."""
    momentum = NORM_MOMENTUM**replicas
    w = layout.views(state.vector)
    hidden = [d for d in layout.layers if d.hidden]
    for d, stats in zip(hidden, known.moments):
        for name, now in zip(("moving_mean", "moving_variance"), stats):
            w[d.name, name][:] = momentum * w[d.name, name] + (1 - momentum) * now
    _adam(layout, state, grad.astype(state.vector.dtype), base_rate, schedule, replicas)


@dataclass
class TrainState:
    """Parameters with the optimiser's moments, as one replica carries them.

    ``steps`` are those of the replica's own optimiser; ``seen`` counts the mini-batches of all
    replicas and drives the schedule of the learning rate.
    """

    vector: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0
    seen: int = 0

    @classmethod
    def fresh(cls, layout: Layout, seed: int) -> TrainState:
        zeros = np.zeros(layout.trainable, layout.dtype)
        return cls(layout.initial(seed), zeros, zeros.copy())

    def copy(self) -> TrainState:
        parts = (self.vector.copy(), self.first.copy(), self.second.copy())
        return TrainState(*parts, self.steps, self.seen)

    def pack(self) -> bytes:
        return np.concatenate([self.vector, self.first, self.second]).tobytes()

    @classmethod
    def unpack(cls, layout: Layout, data: np.ndarray, steps: int, seen: int) -> TrainState:
        at = (layout.size, layout.size + layout.trainable)
        return cls(*(p.copy() for p in np.split(data, at)), steps, seen)


def train_step(
    layout: Layout,
    state: TrainState,
    rows: np.ndarray,
    rng: np.random.Generator,
    base_rate: float,
    schedule: str,
    replicas: int = 1,
) -> float:
    """One optimiser step on a mini-batch, in place; returns the training loss.

    ``replicas`` take such a step at the same time; the schedule and the running statistics move
    on by as many.
    """
    loss, grad = gradient(layout, state.vector, rows, rng, replicas)
    _adam(layout, state, grad, base_rate, schedule, replicas)
    return loss


def _adam(
    layout: Layout,
    state: TrainState,
    grad: np.ndarray,
    base_rate: float,
    schedule: str,
    replicas: int,
) -> None:
    g = grad[: layout.trainable]
    rate = learning_rate(base_rate, schedule, state.seen)
    state.steps += 1
    state.seen += replicas
    state.first += (g - state.first) * (1 - ADAM_BETA1)
    state.second += (g * g - state.second) * (1 - ADAM_BETA2)
    rate *= np.sqrt(1 - ADAM_BETA2**state.steps) / (1 - ADAM_BETA1**state.steps)
    state.vector[: layout.trainable] -= (
        rate * state.first / (np.sqrt(state.second) + ADAM_EPSILON)
    ).astype(state.vector.dtype)
