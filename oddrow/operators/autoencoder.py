"""The autoencoder as Spark jobs: scoring is map-only, training is one job per round."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from oddrow.errors import ConfigurationError, DataLoadError, InferenceError
from oddrow.functions.cells import column
from oddrow.functions.scores import anomaly_flag
from oddrow.operators import network
from oddrow.operators.features import FEATURES
from oddrow.operators.network import BatchSums, Layout, TrainState
from oddrow.params import ArchitectureParams, TrainingParams
from oddrow.shipping import ship_package
from oddrow.sources.storage import Scratch

# A replica's parameters and moments are broadcast and sent back; larger models are refused.
MAX_STATE_BYTES = 128 * 1024 * 1024
# Training rows that are shuffled together. Shards are cut into blocks of this length whatever
# the length of the batches they arrive in, so a model does not depend on session settings.
BLOCK_ROWS = 8_192
# Replicas that one task, or the driver, averages at a time: by number and by size.
MERGE_REPLICAS = 64
MERGE_BYTES = 256 * 1024 * 1024


def state_bytes(layout: Layout) -> int:
    """Size of one replica: parameters and two moments of the trainable ones."""
    return (layout.size + 2 * layout.trainable) * np.dtype(layout.dtype).itemsize


def layout_for(
    architecture: ArchitectureParams, input_dim: int, dtype: str = "float32"
) -> Layout:
    layout = Layout(
        input_dim=input_dim,
        encoder_layers=tuple(architecture.encoder_layers),
        bottleneck_dim=architecture.bottleneck_dim,
        activation=architecture.activation,
        dropout_rate=architecture.dropout_rate,
        dtype=dtype,
    )
    if state_bytes(layout) > MAX_STATE_BYTES:
        raise ConfigurationError(
            f"the model needs {state_bytes(layout)} bytes per replica, more than "
            f"{MAX_STATE_BYTES}: use fewer categories or smaller layers"
        )
    return layout


def _matrix(cells: pa.Array, width: int, dtype: str) -> np.ndarray:
    """Rows of an array column as a matrix, without a copy where types allow."""
    lengths = np.diff(cells.offsets.to_numpy())
    wrong = lengths[lengths != width]
    if wrong.size:
        raise InferenceError(
            f"feature width mismatch: expected {width} features but got {int(wrong[0])}"
        )
    flat = cells.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width).astype(dtype, copy=False)


@dataclass(frozen=True)
class Autoencoder:
    """A trained model: layout and parameters."""

    layout: Layout
    vector: np.ndarray

    def _check(self, df: DataFrame) -> None:
        if FEATURES not in df.columns:
            raise InferenceError(f"rows to score lack the column '{FEATURES}'; encode them first")

    def _check_rows(self, df: DataFrame) -> None:
        self._check(df)
        if not df.isStreaming and df.isEmpty():
            raise InferenceError("cannot score an empty table (0 rows)")

    def _send(self, spark: SparkSession) -> tuple[Layout, Broadcast]:
        ship_package(spark)
        return self.layout, spark.sparkContext.broadcast(self.vector)

    def errors(self, df: DataFrame, features: Column | None = None) -> Column:
        """Reconstruction error per row; only the feature array is sent to Python."""
        layout, vector = self._send(df.sparkSession)

        @arrow_udf("double")
        def mse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            forward = network.Forward(layout, vector.value)
            for batch in batches:
                present = batch.drop_null()
                rows = _matrix(present, layout.input_dim, layout.dtype)
                scores = network.row_errors(rows, forward(rows)).astype(np.float64)
                if len(present) == len(batch):
                    yield pa.array(scores)
                else:
                    out = np.full(len(batch), np.nan)
                    out[batch.is_valid().to_numpy(zero_copy_only=False)] = scores
                    yield pa.array(out)

        return mse(F.col(FEATURES) if features is None else features)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``mse``."""
        self._check(df)
        return df.withColumn("mse", self.errors(df))

    def reconstruct(self, df: DataFrame) -> DataFrame:
        """Add ``reconstruction`` and ``mse``; an empty batch table is an error."""
        self._check_rows(df)
        layout, vector = self._send(df.sparkSession)

        @arrow_udf("struct<reconstruction:array<double>,mse:double>")
        def rebuild(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            forward = network.Forward(layout, vector.value)
            for batch in batches:
                rows = _matrix(batch, layout.input_dim, layout.dtype)
                rebuilt = forward(rows)
                offsets = np.arange(0, rebuilt.size + 1, layout.input_dim, dtype=np.int32)
                arrays = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(rebuilt.astype(np.float64).ravel())
                )
                errors = pa.array(network.row_errors(rows, rebuilt).astype(np.float64))
                yield pa.StructArray.from_arrays([arrays, errors], ["reconstruction", "mse"])

        return df.withColumn("_r", rebuild(F.col(FEATURES))).select(*df.columns, "_r.*")

    def predict(self, df: DataFrame, threshold: float) -> DataFrame:
        """Add ``mse`` and ``prediction``, 1 iff ``mse`` reaches the threshold; an empty batch
        table is an error."""
        self._check_rows(df)
        return self.score(df).withColumn("prediction", anomaly_flag(F.col("mse"), threshold))


VALIDATION_ROUND = -1


@dataclass(frozen=True)
class Shards:
    """Encoded rows as columnar files, one for each shard and round.

    ``table`` has the columns features, is_train, shard and round, the last two as folders, so a
    pass over one round reads the files of that round only. Rows to validate on are in
    ``VALIDATION_ROUND``. Where each round of a shard is one mini-batch (``whole``), its rows lie in
    any order and in any number of files.
    """

    table: DataFrame
    count: int
    rounds: int
    whole: bool = False

    def round(self, *numbers: int) -> DataFrame:
        return self.table.filter(F.col("round").isin(*numbers))


def make_shards(
    df: DataFrame,
    is_train: Column,
    identity: Sequence[str],
    count: int,
    seed: int,
    scratch: Scratch,
    dtype: str = "float32",
    round_rows: int = TrainingParams.round_rows,
    place: Column | None = None,
    batch_size: int = 1,
) -> Shards:
    """Write encoded rows in a fixed number of shards and rounds, in a fixed, seeded order.

    A hash of the features and of the ``identity`` columns places a row, so no single value can
    fill a shard; rows that tie in both are the same to the model. ``place``, a long, may take the
    hash's part where it tells nearly all rows apart. A round of a shard has ``round_rows``
    training rows on average, whatever the size of the table. Every file is written by one task
    as one row group and read by one task in its order, again and again wherever that runs; a
    lost executor costs a re-read only. If a mini-batch takes in all training rows, and they are
    more than a block, nothing is sorted or gathered: a round is read by as many tasks as it is
    large, which add up one step.
    """
    element = "float" if dtype == "float32" else "double"
    told_apart = [F.col(FEATURES), *[column(c) for c in identity]]
    rows = df.withColumn(FEATURES, F.col(FEATURES).cast(f"array<{element}>")).select(
        FEATURES,
        is_train.alias("is_train"),
        (F.xxhash64(F.lit(seed), *told_apart) if place is None else place).alias("_o0"),
        F.xxhash64(F.lit(seed), F.lit("again"), *told_apart).alias("_o1"),
    )
    n = df.filter(is_train).count()
    rounds = max(1, -(-n // (count * round_rows)))
    shard = F.pmod("_o0", F.lit(count)).cast("int")
    turn = F.pmod(F.call_function("div", "_o0", F.lit(count)), F.lit(rounds)).cast("int")
    keys = ["round", "shard"]
    placed = rows.withColumn("shard", shard).withColumn(
        "round", F.when(F.col("is_train"), turn).otherwise(VALIDATION_ROUND)
    )
    path = f"{scratch.path}/shards"
    if n > BLOCK_ROWS and batch_size >= n:
        placed = placed.select(FEATURES, "is_train", *keys)
        placed.write.partitionBy(*keys).parquet(path)
        table = df.sparkSession.read.schema(placed.schema).parquet(path)
        return Shards(table, count, rounds, whole=True)
    placed = (
        placed.repartition(*keys)
        .sortWithinPartitions(*keys, "_o0", "_o1")
        .select(FEATURES, "is_train", *keys)
    )
    width = df.select(F.size(FEATURES)).first()
    row_bytes = (width[0] if width else 1) * np.dtype(dtype).itemsize
    group = max(128 << 20, 2 * round_rows * row_bytes)
    placed.write.partitionBy(*keys).option("parquet.block.size", min(group, 2**31 - 1)).parquet(path)
    table = df.sparkSession.read.schema(placed.schema).parquet(path)
    return Shards(table, count, rounds)


def _recut(blocks: Iterable[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The same rows in blocks of exactly ``size``; the last may be shorter."""
    held: list[np.ndarray] = []
    count = 0
    for block in blocks:
        while len(block):
            part, block = block[: size - count], block[size - count :]
            held.append(part)
            count += len(part)
            if count == size:
                yield np.concatenate(held)
                held, count = [], 0
    if held:
        yield np.concatenate(held)


def _mini_batches(
    blocks: Iterable[np.ndarray], size: int, rng: np.random.Generator
) -> Iterator[np.ndarray]:
    """Mini-batches from a stream of blocks, shuffled inside each block of fixed length."""
    held: np.ndarray | None = None
    for block in _recut(blocks, BLOCK_ROWS):
        block = block[rng.permutation(len(block))]
        if held is not None and len(held):
            block = np.concatenate([held, block])
        full = len(block) // size * size
        for at in range(0, full, size):
            yield block[at : at + size]
        held = block[full:]
    if held is not None and len(held):
        yield held


PASS_SCHEMA = (
    "shard int, n bigint, loss double, val_n bigint, val_loss double, steps bigint, "
    "taken bigint, state binary"
)
_PASS_TYPES = pa.schema(
    [
        ("shard", pa.int32()), ("n", pa.int64()), ("loss", pa.float64()), ("val_n", pa.int64()),
        ("val_loss", pa.float64()), ("steps", pa.int64()), ("taken", pa.int64()),
        ("state", pa.binary()),
    ]
)


_NOTHING = {
    "shard": 0, "n": 0, "loss": 0.0, "val_n": 0, "val_loss": 0.0, "steps": 0, "taken": 0,
    "state": None,
}
HISTORY_SCHEMA = "epoch int, loss double, val_loss double, learning_rate double"


def _pass_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_PASS_TYPES)


def _merge(layout: Layout, parts: list[dict]) -> dict:
    """Row-weighted average of replicas; losses are sums and add up."""
    parts = sorted(parts, key=lambda p: p["shard"])
    n = sum(p["n"] for p in parts)
    state = None
    if n:
        total = np.zeros(layout.size + 2 * layout.trainable, np.float64)
        for p in parts:
            if p["n"]:
                total += np.frombuffer(p["state"], layout.dtype).astype(np.float64) * (p["n"] / n)
        state = total.astype(layout.dtype).tobytes()
    return {
        "shard": parts[0]["shard"],
        "n": n,
        "loss": sum(p["loss"] for p in parts),
        "val_n": sum(p["val_n"] for p in parts),
        "val_loss": sum(p["val_loss"] for p in parts),
        "steps": max(p["steps"] for p in parts),
        "taken": sum(p["taken"] for p in parts),
        "state": state,
    }


def _by_shard(
    batches: Iterable[pa.RecordBatch], layout: Layout
) -> Iterator[tuple[tuple[int, bool], np.ndarray]]:
    """((shard, is_train), rows) for stretches of rows that agree in both."""
    for batch in batches:
        rows = _matrix(batch.column(0), layout.input_dim, layout.dtype)
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        shard = batch.column(2).to_numpy()
        changes = (np.diff(shard) != 0) | (np.diff(train) != 0)
        bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), len(rows)]
        for a, b in zip(bounds, bounds[1:]):
            if a < b:
                yield (int(shard[a]), bool(train[a])), rows[a:b]


SUMS_SCHEMA = "shard int, part int, n bigint, loss double, sums binary"
_SUMS_TYPES = pa.schema(
    [
        ("shard", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("loss", pa.float64()),
        ("sums", pa.binary()),
    ]
)


def _add(parts: list[dict], moments: bool) -> dict:
    """Sums of blocks of one shard together, always in the same order."""
    parts = sorted(parts, key=lambda p: p["part"])
    n, sums = network.add_sums([(p["n"], np.frombuffer(p["sums"])) for p in parts], moments)
    loss = sum(p["loss"] for p in parts)
    return {
        "shard": parts[0]["shard"], "part": parts[0]["part"], "n": n, "loss": loss,
        "sums": sums.tobytes(),
    }


def _in_tree(
    parts: DataFrame, number: str, count: int, fan_in: int, by: Sequence[str], merge, schema: str
) -> DataFrame:
    """Merge numbered rows on the executors, ``fan_in`` at a time, until no more are left."""
    width = 1
    while count > fan_in:
        width *= fan_in
        count = -(-count // fan_in)
        group = F.floor(F.col(number) / width).alias("g")
        parts = parts.groupBy(*by, group).applyInArrow(merge, schema)
    return parts


def _merged(parts: DataFrame, layout: Layout, replicas: int) -> dict:
    """The average of replicas, in a tree on the executors, so that the driver sees few."""

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_pass_batch([_merge(layout, table.to_pylist())])])

    fan_in = max(2, min(MERGE_REPLICAS, MERGE_BYTES // state_bytes(layout)))
    parts = _in_tree(parts, "shard", replicas, fan_in, [], merge, PASS_SCHEMA)
    found = [r.asDict() for r in parts.collect()]
    return _merge(layout, found) if found else dict(_NOTHING)


def _sweep(
    rows: DataFrame, layout: Layout, sent: Broadcast, seeds: Sequence[int], sweep: int
) -> DataFrame:
    """Sums of one sweep over a round, at most a few rows for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, known = sent.value
        part, block = TaskContext.get().partitionId(), 0
        for (shard, _), group in groupby(_by_shard(batches, layout), key=lambda g: g[0]):
            total = None
            for cells in _recut((cells for _, cells in group), BLOCK_ROWS):
                rng = np.random.default_rng([*seeds, shard, part, block])
                block += 1
                loss, sums = network.block_sums(
                    layout, state.vector, cells, rng, known.get(shard, BatchSums.unknown())
                )
                one = {
                    "shard": shard, "part": part, "n": len(cells), "loss": loss,
                    "sums": sums.tobytes(),
                }
                total = one if total is None else _add([total, one], moments)
            yield pa.RecordBatch.from_pylist([total], schema=_SUMS_TYPES)

    def add(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_add(table.to_pylist(), moments)], schema=_SUMS_TYPES)

    moments = sweep < 2 * len(layout.encoder_layers)
    tasks = rows.rdd.getNumPartitions()
    fan_in = max(2, MERGE_BYTES // state_bytes(layout))
    parts = rows.mapInArrow(run, SUMS_SCHEMA)
    return _in_tree(parts, "part", tasks, fan_in, ["shard"], add, SUMS_SCHEMA)


def _whole_pass(
    shards: Shards,
    layout: Layout,
    state: TrainState,
    params: TrainingParams,
    epoch: int,
    turn: int,
) -> dict:
    """The next state after one round in which each shard takes one step over all its rows.

    Every sweep over the rows is a job whose tasks add up blocks, so no task holds a batch.
    """
    rows = shards.round(turn).select(FEATURES, "is_train", "shard")
    spark, replicas = rows.sparkSession, shards.count
    seeds = [params.random_seed, epoch, turn]
    known: dict[int, BatchSums] = {}
    last = BatchSums.sweeps(layout) - 1
    for sweep in range(last):
        sent = spark.sparkContext.broadcast((state, known))
        found = [r.asDict() for r in _sweep(rows, layout, sent, seeds, sweep).collect()]
        sent.destroy()
        for shard, parts in groupby(sorted(found, key=lambda p: p["shard"]), lambda p: p["shard"]):
            both = _add(list(parts), sweep < 2 * len(layout.encoder_layers))
            own = known.setdefault(shard, BatchSums.unknown())
            own.learn(layout, both["n"], np.frombuffer(both["sums"]))

    def stepped(table: pa.Table) -> pa.Table:
        both = _add(table.to_pylist(), moments=False)
        before, stats = sent.value
        own = before.copy()
        network.whole_step(
            layout, own, np.frombuffer(both["sums"]), stats[both["shard"]],
            params.learning_rate, params.lr_schedule, replicas,
        )
        part = _NOTHING | {
            "shard": both["shard"], "n": both["n"], "loss": both["loss"] / layout.input_dim,
            "steps": own.steps, "taken": 1, "state": own.pack(),
        }
        return pa.Table.from_batches([_pass_batch([part])])

    sent = spark.sparkContext.broadcast((state, known))
    parts = _sweep(rows, layout, sent, seeds, last).groupBy("shard")
    result = _merged(parts.applyInArrow(stepped, PASS_SCHEMA), layout, replicas)
    sent.destroy()
    return result


def training_pass(
    shards: Shards,
    layout: Layout,
    state: TrainState,
    params: TrainingParams,
    epoch: int,
    turn: int = 0,
    learn: bool = True,
) -> dict:
    """In the first round of an epoch the validation loss of the incoming state and, if learning,
    the next state after one round; one Spark job, unless a round is one batch."""
    spark = shards.table.sparkSession
    ship_package(spark)
    if shards.whole and learn:
        result = _whole_pass(shards, layout, state, params, epoch, turn)
        if turn == 0:
            checked = training_pass(shards, layout, state, params, epoch, turn, learn=False)
            result |= {k: checked[k] for k in ("val_n", "val_loss")}
        return result
    sent = spark.sparkContext.broadcast(state)
    replicas = shards.count

    def learned(shard: int, blocks: Iterable[np.ndarray]) -> dict:
        rng = np.random.default_rng([params.random_seed, epoch, shard, turn])
        own = sent.value.copy()
        n, loss = 0, 0.0
        for rows in _mini_batches(blocks, params.batch_size, rng):
            step_loss = network.train_step(
                layout, own, rows, rng, params.learning_rate, params.lr_schedule, replicas
            )
            n += len(rows)
            loss += step_loss * len(rows)
        taken = own.steps - sent.value.steps
        return _NOTHING | {
            "shard": shard, "n": n, "loss": loss, "steps": own.steps, "taken": taken,
            "state": own.pack(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward = network.Forward(layout, sent.value.vector)
        for (shard, train), group in groupby(_by_shard(batches, layout), key=lambda g: g[0]):
            if train:
                part = learned(shard, (rows for _, rows in group))
            else:
                part = _NOTHING | {"shard": shard}
                for _, rows in group:
                    errors = network.row_errors(rows, forward(rows))
                    part["val_n"] += len(rows)
                    part["val_loss"] += float(errors.sum(dtype=np.float64))
            yield _pass_batch([part])

    wanted = [VALIDATION_ROUND] if turn == 0 else []
    parts = shards.round(*wanted, *([turn] if learn else [])).select(FEATURES, "is_train", "shard")
    result = _merged(parts.mapInArrow(run, PASS_SCHEMA), layout, replicas)
    sent.destroy()
    return result


@dataclass(frozen=True)
class Epoch:
    """One line of the history, with the state after the epoch (None where it was not kept)."""

    epoch: int
    loss: float
    val_loss: float | None
    learning_rate: float
    state: TrainState | None = None

    @property
    def line(self) -> tuple[int, float, float | None, float]:
        return self.epoch, self.loss, self.val_loss, self.learning_rate


class EarlyStop:
    """Remembers the best epoch and says when ``patience`` epochs in a row were no better."""

    def __init__(self, patience: int) -> None:
        self.patience = patience
        self.best: Epoch | None = None
        self._least, self._waited = math.inf, 0

    def ends_with(self, done: Epoch) -> bool:
        loss = done.val_loss
        if self.best is None or loss is None or loss < self._least:
            self.best, self._waited = done, 0
            if loss is not None and not math.isnan(loss):
                self._least = loss
            return False
        self._waited += 1
        return self._waited >= self.patience


@dataclass(frozen=True)
class TrainingResult:
    model: Autoencoder
    history: list[tuple[int, float, float | None, float]]
    best_epoch: int

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def train_autoencoder(
    shards: Shards,
    layout: Layout,
    params: TrainingParams,
    done: Sequence[Epoch] = (),
    keep: Callable[[Epoch], None] | None = None,
) -> TrainingResult:
    """Train on sharded rows, stop early on validation loss, keep the best parameters.

    In every round each shard runs mini-batch Adam from the same state over its rows of the round,
    then the replicas are averaged by rows. With one shard this is plain sequential mini-batch
    training. A job reports the validation loss of the state it received, so a loss is known one
    job late. ``keep`` is given every finished epoch; training goes on after the epochs in
    ``done``, of which the last and the best must have their state, just as if it had never
    been interrupted.
    """
    stop = EarlyStop(params.patience)
    history = [e.line for e in done]
    ended = [stop.ends_with(e) for e in done]
    state = done[-1].state if done else TrainState.fresh(layout, params.random_seed)
    loss = rate = 0.0
    first = len(done)
    for epoch in range(first, params.max_epochs + 1):
        if ended and ended[-1]:
            break
        learn = epoch < params.max_epochs
        n, total, came = 0, 0.0, state
        for turn in range(shards.rounds if learn else 1):
            result = training_pass(shards, layout, state, params, epoch, turn, learn)
            if turn == 0 and epoch > first:
                val = result["val_loss"] / result["val_n"] if result["val_n"] else None
                finished = Epoch(epoch, loss, val, rate, came)
                history.append(finished.line)
                if keep is not None:
                    keep(finished)
                ended.append(stop.ends_with(finished))
                if ended[-1]:
                    break
            if learn:
                if turn == 0:
                    rate_now = network.learning_rate(
                        params.learning_rate, params.lr_schedule, state.seen
                    )
                n += result["n"]
                total += result["loss"]
                if result["n"]:
                    packed = np.frombuffer(result["state"], layout.dtype)
                    seen = state.seen + result["taken"]
                    state = TrainState.unpack(layout, packed, result["steps"], seen)
        else:
            if learn:
                if not n:
                    raise DataLoadError(
                        "cannot train: the training split holds no normal records"
                    )
                loss, rate = total / n, rate_now
    best = stop.best
    return TrainingResult(Autoencoder(layout, best.state.vector), history, best.epoch)
