"""ANSI SQL that gives the same rows as each query of :mod:`oddrow.plans.queries`."""

from __future__ import annotations

import math

from oddrow.operators.metrics import CLASS_METRICS, HISTOGRAM_BINS, METRIC_NAMES
from oddrow.operators.network import NORM_EPSILON, Layout
from oddrow.plans import training_sql
from oddrow.plans.queries import (
    DIGITS,
    FIXED_LAYOUT,
    PERCENTILE,
    SAMPLE_SIZE,
    STEP_ACTIVATION,
    STEP_BOTTLENECK,
    STEP_EPOCHS,
    STEP_LAYERS,
    STEP_RATE,
    STEP_ROUNDS,
    STEP_SHARDS,
    fixed_vector,
    job_params,
)
from oddrow.profiles import EMBEDDINGS, EVENTS, LINEITEM, Profile

SEED = 42

# Profile columns that are not plain columns of the table, in DuckDB's dialect.
DERIVED = {
    "props_k": "CAST(json_extract_string(props, '$.k') AS DOUBLE)",
    "hour": "CAST(hour(ts) AS DOUBLE)",
} | {f"e{i}": f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64)}


def r(expression: str, name: str) -> str:
    return f"round({expression}, {DIGITS}) + 0.0 AS {name}"


def literal(value: str | int) -> str:
    return str(value) if isinstance(value, int) else f"'{value}'"


def typed(p: Profile) -> str:
    columns = [*p.key, *p.required]
    return "SELECT " + ", ".join(f"{DERIVED[c]} AS {c}" if c in DERIVED else c for c in columns) + (
        f" FROM {p.name}"
    )


def rank(p: Profile) -> str:
    key = ", ".join(f"CAST({c} AS VARCHAR)" for c in p.key)
    return f"md5(concat_ws('|', '{SEED}', {key}))"


def keys(p: Profile) -> str:
    return ", ".join(p.key)


def is_normal(p: Profile) -> str:
    return f"{p.label} IS NOT DISTINCT FROM {literal(p.normal)}"


def y(p: Profile) -> str:
    return f"CASE WHEN {p.label} = {literal(p.normal)} THEN 0 ELSE 1 END"


def prepared(p: Profile) -> str:
    """CTEs up to ``rows``: deduplicated rows with their split."""
    fraction = repr(job_params(p).splits.train_fraction)
    return f"""WITH typed AS ({typed(p)}),
clean AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(p.required)} ORDER BY {keys(p)}) AS copy
    FROM typed) WHERE copy = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {is_normal(p)} ORDER BY {rank(p)}, {keys(p)}) AS place,
    count(*) OVER (PARTITION BY {is_normal(p)}) AS n
  FROM clean),
rows AS (
  SELECT * EXCLUDE (place, n), CASE WHEN NOT ({is_normal(p)}) THEN 'attack'
    WHEN place <= floor(CAST({fraction} AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split
  FROM ranked)"""


def fitted(p: Profile) -> str:
    """CTEs up to ``scaled``: rows with z0, z1, ... beside them."""
    moments = ", ".join(
        f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s{i}"
        for i, c in enumerate(p.numeric)
    )
    z = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(p.numeric))
    return f"""{prepared(p)},
fit AS (SELECT {moments} FROM rows WHERE split = 'train'),
scaled AS (SELECT rows.*, {z} FROM rows, fit)"""


def scored(p: Profile) -> str:
    """CTEs up to ``scores``: key, split, y, mse."""
    squares = " + ".join(f"z{i} * z{i}" for i in range(len(p.numeric)))
    return f"""{fitted(p)},
scores AS (
  SELECT {keys(p)}, split, {y(p)} AS y, ({squares}) / {len(p.numeric)}.0e0 AS mse FROM scaled)"""


def flagged(p: Profile) -> str:
    """CTEs up to ``flags``: scores with the prediction, and ``cells`` of the confusion matrix."""
    return f"""{scored(p)},
lim AS (
  SELECT quantile_cont(mse, {PERCENTILE / 100}) AS threshold, avg(mse) AS mse_mean,
    stddev_pop(mse) AS mse_std FROM scores WHERE split = 'train'),
flags AS (
  SELECT scores.*, CASE WHEN mse >= threshold THEN 1 ELSE 0 END AS prediction FROM scores, lim),
cells AS (
  SELECT CAST(count(*) FILTER (y = 0 AND prediction = 0) AS DOUBLE) AS n00,
    CAST(count(*) FILTER (y = 0 AND prediction = 1) AS DOUBLE) AS n01,
    CAST(count(*) FILTER (y = 1 AND prediction = 0) AS DOUBLE) AS n10,
    CAST(count(*) FILTER (y = 1 AND prediction = 1) AS DOUBLE) AS n11 FROM flags)"""


def _or_zero(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0 ELSE ({part}) / ({whole}) END"


METRIC_SQL = {
    "precision_normal": _or_zero("n00", "n00 + n10"),
    "recall_normal": _or_zero("n00", "n00 + n01"),
    "f1_normal": _or_zero("2 * n00", "2 * n00 + n10 + n01"),
    "precision_anomalous": _or_zero("n11", "n11 + n01"),
    "recall_anomalous": _or_zero("n11", "n11 + n10"),
    "f1_anomalous": _or_zero("2 * n11", "2 * n11 + n01 + n10"),
    "accuracy": _or_zero("n00 + n11", "n00 + n01 + n10 + n11"),
}


def metrics(p: Profile) -> str:
    columns = ", ".join(r(METRIC_SQL[name], name) for name in METRIC_NAMES)
    return f"{flagged(p)} SELECT {columns} FROM cells"


def threshold(p: Profile) -> str:
    columns = ", ".join(r(c, c) for c in ("threshold", "mse_mean", "mse_std"))
    return f"{flagged(p)} SELECT {PERCENTILE} AS percentile, {columns} FROM lim"


# Groups per distinct score with running sums from the highest score down.
GROUPS = """groups AS (
  SELECT mse, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
  FROM scores GROUP BY mse),
running AS (
  SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
    lead(pos) OVER (ORDER BY mse DESC) AS next_pos, lead(neg) OVER (ORDER BY mse DESC) AS next_neg,
    sum(pos) OVER () AS p, sum(neg) OVER () AS q
  FROM groups
  WINDOW w AS (ORDER BY mse DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
area AS (SELECT sum(neg * (tps - pos / 2)) / (max(p) * max(q)) AS auc FROM running)"""


def auc(p: Profile) -> str:
    return (
        f"{scored(p)}, {GROUPS} SELECT {r('auc', 'auc_roc')}, auc < 0.8 AS below_warning FROM area"
    )


def roc(p: Profile) -> str:
    return f"""{scored(p)}, {GROUPS}
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0e0 AS fpr, 0.0e0 AS tpr
UNION ALL
SELECT {r("mse", "threshold")}, {r("fps / q", "fpr")}, {r("tps / p", "tpr")} FROM running
WHERE next_pos IS NULL OR tps + fps = pos + neg OR pos <> next_pos OR neg <> next_neg"""


def histogram(p: Profile) -> str:
    n = HISTOGRAM_BINS
    lower = f"lo + i * ((hi - lo) / {n})"
    upper = f"CASE WHEN i = {n - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {n}) END"
    return f"""{scored(p)},
spans AS (
  SELECT y, CASE WHEN min(mse) = max(mse) THEN min(mse) - 0.5 ELSE min(mse) END AS lo,
    CASE WHEN min(mse) = max(mse) THEN max(mse) + 0.5 ELSE max(mse) END AS hi
  FROM scores GROUP BY y),
bins AS (
  SELECT y, CAST(i AS INTEGER) AS i, {lower} AS lower, {upper} AS upper
  FROM spans, range(0, {n}) AS t(i)),
counted AS (
  SELECT b.y, b.i, count(s.mse) AS records
  FROM bins b LEFT JOIN scores s ON s.y = b.y AND s.mse >= b.lower
    AND (s.mse < b.upper OR (b.i = {n - 1} AND s.mse <= b.upper))
  GROUP BY b.y, b.i)
SELECT b.y AS label, b.i AS bin, {r("lower", "lower")}, {r("upper", "upper")}, records
FROM bins b JOIN counted c ON b.y = c.y AND b.i = c.i"""


def feature_cells(p: Profile) -> list[str]:
    """Cells of the assembled features; the categories of the only categorical column are F, O."""
    cells = []
    if p.categorical:
        cells = [f"CASE WHEN {p.categorical[0]} = '{c}' THEN 1.0e0 ELSE 0.0e0 END" for c in "FO"]
    return cells + [f"z{i}" for i in range(len(p.numeric))]


def features(p: Profile) -> str:
    listed = ", ".join(r(cell, f"f{i}") for i, cell in enumerate(feature_cells(p)))
    return f"{fitted(p)} SELECT {keys(p)}, split, {listed} FROM scaled"


def scaler(p: Profile) -> str:
    parts = [
        f"SELECT '{c}' AS column, {r(f'avg({c})', 'mean')}, {r(f'stddev_pop({c})', 'std')}, "
        f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, {DIGITS}) + 0.0 "
        "AS scale FROM rows WHERE split = 'train'"
        for c in p.numeric
    ]
    return f"{prepared(p)} " + " UNION ALL ".join(parts)


def quality(p: Profile) -> str:
    counts = [f"count(*) FILTER ({c} IS NULL) AS missing_{i}" for i, c in enumerate(p.features)]
    counts += [
        f"count(*) FILTER (isinf({c})) AS infinite_{i}"
        for i, c in enumerate(p.features)
        if c in p.numeric
    ]
    return f"""WITH typed AS ({typed(p)})
SELECT count(*) AS total, count(*) FILTER ({is_normal(p)}) AS normal,
  count(*) FILTER ({p.label} IS NOT NULL AND NOT ({is_normal(p)})) AS attack,
  count(*) FILTER ({p.label} IS NULL) AS missing_label, {", ".join(counts)} FROM typed"""


def class_counts(p: Profile) -> str:
    return f"""SELECT count(*) AS total, count(*) FILTER ({is_normal(p)}) AS normal,
  count(*) FILTER (NOT ({is_normal(p)})) AS attack FROM {p.name}"""


def labels(p: Profile) -> str:
    return f"SELECT {p.label} AS label, count(*) AS records FROM {p.name} GROUP BY 1"


def binarize(p: Profile) -> str:
    return f"SELECT {keys(p)}, {p.label}, {y(p)} AS y FROM {p.name}"


def sample(p: Profile) -> str:
    return f"SELECT {keys(p)}, {p.label} FROM {p.name} ORDER BY {rank(p)} LIMIT {SAMPLE_SIZE}"


def forward(p: Profile, layout: Layout) -> str:
    """CTEs up to ``net``: the fixed network written out as arithmetic, one CTE per layer."""
    w = layout.views(fixed_vector(layout))
    ctes, inputs, came = [], [f"z{i}" for i in range(len(p.numeric))], "scaled"
    for step, d in enumerate(layout.layers):
        units = []
        for j in range(d.n_out):
            column = w[d.name, "kernel"][:, j]
            terms = [f"({float(v)!r}e0) * {x}" for v, x in zip(column, inputs, strict=True)]
            unit = " + ".join([*terms, f"({float(w[d.name, 'bias'][j])!r}e0)"])
            if d.activation == "relu":
                unit = f"greatest({unit}, 0.0e0)"
            if d.hidden:
                mean, var, gamma, beta = (
                    f"({float(w[d.name, k][j])!r}e0)"
                    for k in ("moving_mean", "moving_variance", "gamma", "beta")
                )
                unit = f"({unit} - {mean}) * ({gamma} / sqrt({var} + {NORM_EPSILON}e0)) + {beta}"
            units.append(f"{unit} AS h{step}_{j}")
        ctes.append(f"layer{step} AS (SELECT *, {', '.join(units)} FROM {came})")
        inputs, came = [f"h{step}_{j}" for j in range(d.n_out)], f"layer{step}"
    squares = " + ".join(f"(z{i} - {x}) * (z{i} - {x})" for i, x in enumerate(inputs))
    rebuilt = ", ".join(f"{x} AS r{i}" for i, x in enumerate(inputs))
    mse = f"({squares}) / {len(inputs)}.0e0 AS mse"
    net = f"net AS (SELECT {keys(p)}, split, {rebuilt}, {mse} FROM {came})"
    return ",\n".join([fitted(p), *ctes, net])


def trained(p: Profile, shards: int = STEP_SHARDS, rounds: int = STEP_ROUNDS) -> str:
    """CTEs up to ``history`` and ``best``, with ``base``: encoded rows in shards and rounds."""
    place = f"CAST('0x' || substr({rank(p)}, 1, 15) AS BIGINT)"
    cells = [f"{c} AS x{i}" for i, c in enumerate(feature_cells(p))]
    layout = step_layout(p)
    return f"""{fitted(p)},
base AS MATERIALIZED (
  SELECT {keys(p)}, split, {y(p)} AS y, {", ".join(cells)}, {place} % {shards} AS shard,
    ({place} // {shards}) % {rounds} AS turn FROM scaled),
{training_sql.training(layout, "base", SEED, STEP_RATE, STEP_EPOCHS, rounds, shards)}"""


def step_layout(p: Profile) -> Layout:
    width = len(feature_cells(p))
    return Layout(width, STEP_LAYERS, STEP_BOTTLENECK, STEP_ACTIVATION, 0.0, "float64")


def history(p: Profile) -> str:
    columns = ", ".join(r(c, c) for c in ("loss", "val_loss", "learning_rate"))
    return f"{trained(p)} SELECT epoch, {columns} FROM history"


def weights(p: Profile) -> str:
    lines, at = [], 0
    for layer, name, shape, _ in step_layout(p).parameters:
        for cell in range(math.prod(shape)):
            lines.append(
                f"SELECT '{layer}' AS layer, '{name}' AS parameter, {cell} AS cell, "
                f"{r(f'p{at}', 'value')} FROM best"
            )
            at += 1
    return f"{trained(p)} " + " UNION ALL ".join(lines)


def trained_scores(p: Profile, columns: str, shards: int, rounds: int) -> str:
    scores = training_sql.forward(step_layout(p), "base", "best", "net", f"{keys(p)}, split, y")
    return f"""{trained(p, shards, rounds)},
{scores},
lim AS (SELECT quantile_cont(mse, {PERCENTILE / 100}) AS threshold FROM net WHERE split = 'train')
SELECT {columns}, {r("mse", "mse")}, CASE WHEN mse >= threshold THEN 1 ELSE 0 END AS prediction
FROM net, lim"""


def report(p: Profile) -> str:
    def percent(name: str) -> str:
        return f"printf('%.2f%%', 100 * ({METRIC_SQL[name]}))"

    lines = [
        ("Accuracy", percent("accuracy"), "NULL", "NULL"),
        ("AUC-ROC", "printf('%.4f', auc)", "NULL", "NULL"),
        ("Threshold", "printf('%.6f', threshold)", "NULL", "NULL"),
        ("Percentile", f"'{PERCENTILE}th pct'", "NULL", "NULL"),
        (
            "MSE mean / std",
            "printf('%.6f', mse_mean) || ' / ' || printf('%.6f', mse_std)", "NULL", "NULL",
        ),
        ("Training time", "'N/A'", "NULL", "NULL"),
    ]
    for name in CLASS_METRICS:
        shown = "F1" if name == "f1" else name.capitalize()
        lines.append((shown, "NULL", percent(f"{name}_normal"), percent(f"{name}_anomalous")))
    selects = [
        f"SELECT '{m}' AS metric, CAST({v} AS VARCHAR) AS value, CAST({n} AS VARCHAR) AS normal, "
        f"CAST({a} AS VARCHAR) AS anomalous FROM cells, lim, area"
        for m, v, n, a in lines
    ]
    return f"{flagged(p)}, {GROUPS} " + " UNION ALL ".join(selects)


def end_to_end(p: Profile) -> str:
    columns = ", ".join(r(METRIC_SQL[name], name) for name in METRIC_NAMES)
    return f"""{flagged(p)}, {GROUPS},
sizes AS (
  SELECT count(*) FILTER (split = 'train') AS train_rows,
    count(*) FILTER (split = 'val') AS val_rows, count(*) AS test_rows,
    count(*) FILTER (prediction = 1) AS flagged_rows FROM flags)
SELECT sizes.*, {columns}, {r("auc", "auc_roc")}, {r("threshold", "threshold")}
FROM sizes, cells, lim, area"""


RAW_EVENTS = (
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
    "value, event_type FROM events"
)


def all_oracles() -> dict[str, str]:
    p = LINEITEM
    required = ", ".join(p.required)
    out = {
        "normal_rows": f"SELECT {keys(p)}, {required}, 0 AS y FROM lineitem WHERE {is_normal(p)}",
        "attack_rows": f"SELECT {keys(p)}, {required} FROM lineitem WHERE NOT ({is_normal(p)})",
        "categorical_columns": f"SELECT {keys(p)}, l_linestatus FROM lineitem",
        "numeric_columns": f"WITH typed AS ({typed(EVENTS)}) SELECT event_id, "
        + ", ".join(r(c, c) for c in EVENTS.numeric)
        + " FROM typed",
        "csv_scan": "SELECT "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in p.key)
        + f", {required} FROM lineitem",
        "dedup_rows": """SELECT doc_id, text, lang, source, n_chars, copies FROM (
  SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS copy,
    count(*) OVER (PARTITION BY text, lang) AS copies FROM documents) WHERE copy = 1""",
        "dedup_report": f"""WITH doubled AS (
  SELECT {required} FROM lineitem
  UNION ALL SELECT {required} FROM lineitem WHERE NOT ({is_normal(p)})),
grouped AS (SELECT count(*) AS n FROM doubled GROUP BY {required})
SELECT CAST(sum(n) AS BIGINT) AS rows_before, CAST(sum(n - 1) AS BIGINT) AS rows_removed,
  count(*) AS rows_after FROM grouped""",
        "dedup_lineitem": f"""WITH doubled AS (
  SELECT {keys(p)}, {required} FROM lineitem
  UNION ALL SELECT {keys(p)}, {required} FROM lineitem WHERE {is_normal(p)})
SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER (PARTITION BY {required} ORDER BY {keys(p)}) AS copy,
    count(*) OVER (PARTITION BY {required}) AS copies FROM doubled) WHERE copy = 1""",
        "test_rows": f"{prepared(p)} SELECT {keys(p)}, {y(p)} AS y FROM rows",
        "scaler_transform": f"{fitted(p)} SELECT {keys(p)}, "
        + ", ".join(r(f"z{i}", c) for i, c in enumerate(p.numeric))
        + " FROM scaled",
        "ohe_fit": f"{prepared(p)} SELECT DISTINCT 'l_linestatus' AS column, "
        "l_linestatus AS category FROM rows WHERE split = 'train'",
        "ohe_transform": f"""{prepared(p)},
slots AS (
  SELECT l_linestatus AS category, row_number() OVER (ORDER BY l_linestatus) AS slot
  FROM (SELECT DISTINCT l_linestatus FROM rows WHERE split = 'train'))
SELECT {keys(p)}, l_linestatus,
  CASE WHEN slot = 1 THEN 1.0e0 ELSE 0.0e0 END AS f0,
  CASE WHEN slot = 2 THEN 1.0e0 ELSE 0.0e0 END AS f1
FROM rows LEFT JOIN slots ON l_linestatus = category""",
        "unknown_category_zero_block": f"SELECT {keys(p)}, l_linestatus, "
        "CASE WHEN l_linestatus = 'F' THEN 1.0e0 ELSE 0.0e0 END AS f0 FROM lineitem",
        "score_stats": f"{scored(p)} SELECT {r('avg(mse)', 'mse_mean')}, "
        f"{r('stddev_pop(mse)', 'mse_std')} FROM scores WHERE split = 'train'",
        "normal_scores": f"{scored(p)} SELECT {keys(p)}, {r('mse', 'mse')} FROM scores WHERE y = 0",
        "attack_scores": f"{scored(p)} SELECT {keys(p)}, {r('mse', 'mse')} FROM scores WHERE y = 1",
        "anomaly_end_to_end": end_to_end(p),
        "run_report": report(p),
        "reconstruct_fixed_weights": f"{forward(EVENTS, FIXED_LAYOUT)} SELECT event_id, "
        + ", ".join(r(f"r{i}", f"r{i}") for i in range(FIXED_LAYOUT.input_dim))
        + f", {r('mse', 'mse')} FROM net",
        "score_fixed_weights": f"{forward(EVENTS, FIXED_LAYOUT)} SELECT event_id, "
        f"{r('mse', 'mse')}, CASE WHEN mse >= 1.0 THEN 1 ELSE 0 END AS prediction FROM net",
        "threshold_artefact": threshold(p),
        "scaler_artefact": scaler(p),
        "encoder_artefact": f"""{prepared(p)}
SELECT 'l_linestatus' AS column,
  CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS place, category
FROM (SELECT DISTINCT l_linestatus AS category FROM rows WHERE split = 'train')""",
        "score_job": f"""{forward(EVENTS, FIXED_LAYOUT)},
lim AS (SELECT quantile_cont(mse, {PERCENTILE / 100}) AS threshold FROM net WHERE split = 'train')
SELECT event_id, {r('mse', 'mse')}, CASE WHEN mse >= threshold THEN 1 ELSE 0 END AS prediction
FROM net, lim""",
        "train_job": trained_scores(EVENTS, "event_id", STEP_SHARDS, 1),
        "prepare_dataset": RAW_EVENTS,
        "prepare_sample": f"{RAW_EVENTS} ORDER BY "
        f"md5(concat_ws('|', '{SEED}', CAST(event_id AS VARCHAR))) LIMIT {SAMPLE_SIZE}",
        "prepare_summary": class_counts(EVENTS),
    }
    for name, sql, profiles in (
        ("class_counts", class_counts, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("distinct_labels", labels, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("quality_gate", quality, (LINEITEM, EVENTS)),
        ("binarize_label", binarize, (LINEITEM, EVENTS, EMBEDDINGS)),
        (
            "split_train_val",
            lambda q: f"{prepared(q)} SELECT {keys(q)}, split FROM rows",
            (LINEITEM, EVENTS),
        ),
        (
            "split_sizes",
            lambda q: f"{prepared(q)} SELECT split, count(*) AS records FROM rows GROUP BY split",
            (LINEITEM, EVENTS, EMBEDDINGS),
        ),
        ("sample_n", sample, (LINEITEM, EVENTS)),
        ("scaler_fit", scaler, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("assemble_features", features, (LINEITEM, EVENTS, EMBEDDINGS)),
        (
            "scores",
            lambda q: f"{scored(q)} SELECT {keys(q)}, split, y, {r('mse', 'mse')} FROM scores",
            (LINEITEM, EVENTS),
        ),
        ("threshold_percentile", threshold, (LINEITEM, EVENTS)),
        (
            "predict_flags",
            lambda q: f"{flagged(q)} SELECT {keys(q)}, y, prediction FROM flags",
            (LINEITEM, EVENTS),
        ),
        (
            "confusion_matrix",
            lambda q: f"{flagged(q)} "
            + " UNION ALL ".join(
                f"SELECT {t} AS true_label, {v} AS predicted_label, "
                f"CAST(n{t}{v} AS BIGINT) AS records FROM cells"
                for t in (0, 1)
                for v in (0, 1)
            ),
            (LINEITEM, EVENTS),
        ),
        ("classification_metrics", metrics, (LINEITEM, EVENTS)),
        ("auc_roc", auc, (LINEITEM, EVENTS)),
        ("roc_curve", roc, (LINEITEM, EVENTS)),
        ("error_histogram", histogram, (LINEITEM, EVENTS)),
        ("training_history", history, (EMBEDDINGS, LINEITEM)),
        ("train_epoch", weights, (EVENTS, LINEITEM)),
        (
            "train_steps_score",
            lambda q: trained_scores(q, f"{keys(q)}, split, y", STEP_SHARDS, STEP_ROUNDS),
            (EVENTS, LINEITEM),
        ),
    ):
        for profile in profiles:
            out[f"{name}_{profile.name}"] = sql(profile)
    return out
