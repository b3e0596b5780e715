"""SQL that trains the autoencoder: one Adam step per shard and round, written as aggregates.

Rows carry their features ``x0, x1, ...``, ``split``, ``shard`` and ``turn``. A state is one row:
parameters ``p<i>`` in the order of the layout's vector, moments ``m<i>`` and ``v<i>`` of the
trainable ones. Batch statistics and the means inside the backward pass are windows over a shard,
gradients are sums over it, and replicas meet in a sum weighted by their rows.

Hidden units are tanh: behind a normalised unit that is linear over all rows (as an always active
relu is) the bias has no gradient but rounding errors, which Adam would magnify.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from oddrow.operators.network import (
    ADAM_BETA1,
    ADAM_BETA2,
    ADAM_EPSILON,
    NORM_EPSILON,
    NORM_MOMENTUM,
    Dense,
    Layout,
)


def number(value: float) -> str:
    return f"({float(value)!r}::DOUBLE)"


class Places:
    """Names of parameters in a state."""

    def __init__(self, layout: Layout) -> None:
        self._start, at = {}, 0
        self._width = {}
        for layer, name, shape, _ in layout.parameters:
            self._start[layer, name] = at
            self._width[layer, name] = shape[-1]
            at += int(np.prod(shape))

    def index(self, d: Dense, name: str, j: int, i: int = 0) -> int:
        return self._start[d.name, name] + i * self._width[d.name, name] + j

    def of(self, d: Dense, name: str, j: int, i: int = 0) -> str:
        return f"p{self.index(d, name, j, i)}"


def _units(places: Places, d: Dense, inputs: Sequence[str]) -> list[str]:
    made = []
    for j in range(d.n_out):
        terms = [f"{x} * {places.of(d, 'kernel', j, i)}" for i, x in enumerate(inputs)]
        unit = " + ".join([*terms, places.of(d, "bias", j)])
        made.append(unit if d.activation == "linear" else f"{d.activation}({unit})")
    return made


def forward(layout: Layout, rows: str, state: str, name: str, keep: str) -> str:
    """CTEs up to ``name``: the columns ``keep`` and the error ``mse`` of every row."""
    places = Places(layout)
    inputs = [f"x{i}" for i in range(layout.input_dim)]
    ctes, came = [], f"(SELECT {rows}.*, {state}.* FROM {rows}, {state})"
    for step, d in enumerate(layout.layers):
        units = []
        for j, unit in enumerate(_units(places, d, inputs)):
            if d.hidden:
                gamma, beta, mean, var = (
                    places.of(d, k, j)
                    for k in ("gamma", "beta", "moving_mean", "moving_variance")
                )
                spread = f"sqrt({var} + {number(NORM_EPSILON)})"
                unit = f"({unit} - {mean}) * ({gamma} / {spread}) + {beta}"
            units.append(f"{unit} AS h{step}_{j}")
        ctes.append(f"{name}_{step} AS (SELECT *, {', '.join(units)} FROM {came})")
        inputs, came = [f"h{step}_{j}" for j in range(d.n_out)], f"{name}_{step}"
    squares = " + ".join(f"(x{i} - {h}) * (x{i} - {h})" for i, h in enumerate(inputs))
    mse = f"({squares}) / {layout.input_dim}.0::DOUBLE AS mse"
    ctes.append(f"{name} AS MATERIALIZED (SELECT {keep}, {mse} FROM {came})")
    return ",\n".join(ctes)


def initial_state(layout: Layout, seed: int) -> str:
    cells = [f"{number(v)} AS p{i}" for i, v in enumerate(layout.initial(seed))]
    cells += [f"0::DOUBLE AS {k}{i}" for k in "mv" for i in range(layout.trainable)]
    return f"state0 AS MATERIALIZED (SELECT {', '.join(cells)})"


def _over(expression: str) -> str:
    return f"avg({expression}) OVER (PARTITION BY shard)"


def step(layout: Layout, rows: str, turn: int, k: int, rate: float, shards: int) -> str:
    """CTEs from ``state<k>`` to ``state<k+1>``; ``grads<k>`` holds rows and loss by shard."""
    places = Places(layout)
    ctes: list[str] = []
    own = f"split = 'train' AND turn = {turn}"
    came = f"(SELECT {rows}.*, state{k}.* FROM {rows}, state{k} WHERE {own})"

    def add(columns: list[str]) -> None:
        nonlocal came
        ctes.append(f"s{k}_{len(ctes)} AS (SELECT *, {', '.join(columns)} FROM {came})")
        came = f"s{k}_{len(ctes) - 1}"

    inputs: list[list[str]] = [[f"x{i}" for i in range(layout.input_dim)]]
    for at, d in enumerate(layout.layers):
        add([f"{u} AS a{at}_{j}" for j, u in enumerate(_units(places, d, inputs[-1]))])
        names = [f"a{at}_{j}" for j in range(d.n_out)]
        if d.hidden:
            stats = [f"{_over(a)} AS mu{at}_{j}" for j, a in enumerate(names)]
            stats += [
                f"var_pop({a}) OVER (PARTITION BY shard) AS var{at}_{j}"
                for j, a in enumerate(names)
            ]
            add(stats)
            add([
                f"({a} - mu{at}_{j}) / sqrt(var{at}_{j} + {number(NORM_EPSILON)}) AS n{at}_{j}"
                for j, a in enumerate(names)
            ])
            names = [
                f"(n{at}_{j} * {places.of(d, 'gamma', j)} + {places.of(d, 'beta', j)})"
                for j in range(d.n_out)
            ]
            add([f"{x} AS o{at}_{j}" for j, x in enumerate(names)])
            names = [f"o{at}_{j}" for j in range(d.n_out)]
        inputs.append(names)

    width = layout.input_dim
    miss = [f"({h} - x{i})" for i, h in enumerate(inputs[-1])]
    add([f"({' + '.join(f'{m} * {m}' for m in miss)}) / {width}.0::DOUBLE AS mse"])
    size = f"(count(*) OVER (PARTITION BY shard) * {width}.0::DOUBLE)"
    last = len(layout.layers) - 1
    add([f"{m} * (2.0::DOUBLE / {size}) AS g{last}_{j}" for j, m in enumerate(miss)])
    sums: dict[int, str] = {}
    moving: dict[int, str] = {}
    for at, d in reversed(list(enumerate(layout.layers))):
        own = [f"g{at}_{j}" for j in range(d.n_out)]
        if d.hidden:
            for j, g in enumerate(own):
                sums[places.index(d, "gamma", j)] = f"sum({g} * n{at}_{j})"
                sums[places.index(d, "beta", j)] = f"sum({g})"
                moving[places.index(d, "moving_mean", j)] = f"any_value(mu{at}_{j})"
                moving[places.index(d, "moving_variance", j)] = f"any_value(var{at}_{j})"
            add([f"{g} * {places.of(d, 'gamma', j)} AS e{at}_{j}" for j, g in enumerate(own)])
            means = [f"{_over(f'e{at}_{j}')} AS em{at}_{j}" for j in range(d.n_out)]
            means += [f"{_over(f'e{at}_{j} * n{at}_{j}')} AS en{at}_{j}" for j in range(d.n_out)]
            add(means)
            own = [
                f"((e{at}_{j} - em{at}_{j} - n{at}_{j} * en{at}_{j}) "
                f"/ sqrt(var{at}_{j} + {number(NORM_EPSILON)}))"
                for j in range(d.n_out)
            ]
        if d.activation == "tanh":
            own = [f"{g} * (1 - a{at}_{j} * a{at}_{j})" for j, g in enumerate(own)]
        add([f"{g} AS d{at}_{j}" for j, g in enumerate(own)])
        for j in range(d.n_out):
            sums[places.index(d, "bias", j)] = f"sum(d{at}_{j})"
            for i, x in enumerate(inputs[at]):
                sums[places.index(d, "kernel", j, i)] = f"sum({x} * d{at}_{j})"
        if at:
            add([
                " + ".join(f"d{at}_{j} * {places.of(d, 'kernel', j, i)}" for j in range(d.n_out))
                + f" AS g{at - 1}_{i}"
                for i in range(d.n_in)
            ])

    cells = [f"{e} AS q{i}" for i, e in sorted((sums | moving).items())]
    ctes.append(
        f"grads{k} AS MATERIALIZED (SELECT shard, count(*)::DOUBLE AS n, avg(mse) AS loss, "
        f"{', '.join(cells)} FROM {came} GROUP BY shard)"
    )
    bare = 1 - NORM_MOMENTUM**shards
    moved = []
    for i in range(layout.trainable):
        moved.append(f"m{i} + (q{i} - m{i}) * {number(1 - ADAM_BETA1)} AS nm{i}")
        moved.append(f"v{i} + (q{i} * q{i} - v{i}) * {number(1 - ADAM_BETA2)} AS nv{i}")
    ctes.append(f"s{k}_moved AS (SELECT *, {', '.join(moved)} FROM grads{k}, state{k})")
    scaled = rate * np.sqrt(1 - ADAM_BETA2 ** (k + 1)) / (1 - ADAM_BETA1 ** (k + 1))
    merged = []
    for i in range(layout.size):
        if i < layout.trainable:
            value = f"p{i} - {number(scaled)} * nm{i} / (sqrt(nv{i}) + {number(ADAM_EPSILON)})"
        else:
            value = f"p{i} * {number(1 - bare)} + q{i} * {number(bare)}"
        merged.append(f"sum(n * ({value})) / sum(n) AS p{i}")
    learned = range(layout.trainable)
    merged += [f"sum(n * n{c}{i}) / sum(n) AS {c}{i}" for c in "mv" for i in learned]
    ctes.append(
        f"state{k + 1} AS MATERIALIZED (SELECT {', '.join(merged)} FROM s{k}_moved)"
    )
    return ",\n".join(ctes)


def training(
    layout: Layout, rows: str, seed: int, rate: float, epochs: int, rounds: int, shards: int
) -> str:
    """CTEs of the whole training: ``history`` and ``best``, the state with the least val_loss."""
    ctes = [
        initial_state(layout, seed),
        f"held_out AS MATERIALIZED (SELECT * FROM {rows} WHERE split = 'val')",
    ]
    lines = []
    for epoch in range(1, epochs + 1):
        steps = range((epoch - 1) * rounds, epoch * rounds)
        ctes += [step(layout, rows, k % rounds, k, rate, shards) for k in steps]
        ctes.append(forward(layout, "held_out", f"state{epoch * rounds}", f"val{epoch}", "split"))
        parts = " UNION ALL ".join(f"SELECT n, loss FROM grads{k}" for k in steps)
        lines.append(
            f"SELECT {epoch} AS epoch, (SELECT sum(n * loss) / sum(n) FROM ({parts})) AS loss, "
            f"(SELECT avg(mse) FROM val{epoch}) AS val_loss, {number(rate)} AS learning_rate"
        )
    ctes.append(f"history AS MATERIALIZED ({' UNION ALL '.join(lines)})")
    states = " UNION ALL ".join(
        f"SELECT {e} AS epoch, * FROM state{e * rounds}" for e in range(1, epochs + 1)
    )
    ctes.append(
        f"best AS MATERIALIZED (SELECT states.* EXCLUDE (epoch) FROM ({states}) AS states "
        "JOIN history USING (epoch) ORDER BY val_loss, epoch LIMIT 1)"
    )
    return ",\n".join(ctes)
