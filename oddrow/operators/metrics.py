"""Evaluation of predictions and scores: confusion matrix, rates, ROC, AUC, error histogram."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from oddrow.functions.cells import one_row
from oddrow.sources.storage import Scratch

LABEL, PREDICTION, SCORE = "y", "prediction", "mse"
HISTOGRAM_BINS = 30
AUC_WARNING_LEVEL = 0.80

CLASS_METRICS = ("precision", "recall", "f1")
METRIC_NAMES = tuple(f"{m}_{c}" for c in ("normal", "anomalous") for m in CLASS_METRICS) + (
    "accuracy",
)


def _cells() -> list[Column]:
    y, p = F.col(LABEL), F.col(PREDICTION)
    return [
        F.count_if((y == t) & (p == q)).alias(f"n{t}{q}") for t in (0, 1) for q in (0, 1)
    ]


def cell_counts(df: DataFrame) -> DataFrame:
    """One row with the confusion counts n00, n01, n10, n11 (true label, prediction)."""
    return df.agg(*_cells())


@dataclass(frozen=True)
class Span:
    """The finite scores of a class, and how many of its scores are infinite."""

    y: int
    lo: float | None
    hi: float | None
    below: int
    above: int


def _span_measures(of_class: Column) -> list[Column]:
    s = F.when(of_class, F.col(SCORE).cast("double"))
    finite = F.when(F.abs(s) < math.inf, s)
    return [
        F.min(finite), F.max(finite), F.count_if(s == -math.inf), F.count_if(s == math.inf)
    ]


def summarise(df: DataFrame) -> tuple[DataFrame, list[Span]]:
    """In one pass over flagged rows: the cells of the confusion matrix as one row, and the span
    of the scores of each class."""
    measures = [
        m.alias(f"{name}_{y}")
        for y in (0, 1)
        for name, m in zip(("lo", "hi", "below", "above"), _span_measures(F.col(LABEL) == y))
    ]
    found = df.agg(*_cells(), *measures).first().asDict()
    counts = {k: v for k, v in found.items() if k.startswith("n")}
    schema = ", ".join(f"{name} bigint" for name in counts)
    spans = [
        Span(y, *(found[f"{name}_{y}"] for name in ("lo", "hi", "below", "above")))
        for y in (0, 1)
    ]
    return one_row(df.sparkSession, counts, schema), spans


def _counted(df: DataFrame) -> DataFrame:
    return df if "n00" in df.columns else cell_counts(df)


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Four rows (true label, predicted label, records); cells without records stay.

    Takes flagged rows, or the result of :func:`cell_counts`.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("true_label"),
                F.lit(q).alias("predicted_label"),
                F.col(f"n{t}{q}").alias("records"),
            )
            for t in (0, 1)
            for q in (0, 1)
        ]
    )
    return _counted(df).select(F.explode(cells).alias("c")).select("c.*")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame) -> DataFrame:
    """One row: precision, recall and F1 per class, and accuracy; x/0 counts as 0.

    Takes flagged rows, or the result of :func:`cell_counts`.
    """
    n = {k: F.col(f"n{k}") for k in ("00", "01", "10", "11")}
    out = []
    for name, hit, missed, false in (
        ("normal", n["00"], n["01"], n["10"]),
        ("anomalous", n["11"], n["10"], n["01"]),
    ):
        out += [
            _ratio(hit, hit + false).alias(f"precision_{name}"),
            _ratio(hit, hit + missed).alias(f"recall_{name}"),
            _ratio(hit * 2, hit * 2 + false + missed).alias(f"f1_{name}"),
        ]
    total = n["00"] + n["01"] + n["10"] + n["11"]
    out.append(_ratio(n["00"] + n["11"], total).alias("accuracy"))
    return _counted(df).select(*out)


@dataclass(frozen=True)
class RankedScores:
    """Positives and negatives per distinct score, in ranges of the descending order.

    ``groups`` is a stored table: range ``r`` (0 has the highest scores), score ``s``, ``pos``,
    ``neg``, their running sums ``tps`` and ``fps`` inside the range, and the counts of the next
    lower score in it. ``ranges`` holds one row per range, from the highest scores down.
    """

    groups: DataFrame
    ranges: list[Row]
    scratch: Scratch

    @property
    def positives(self) -> int:
        return sum(r.pos for r in self.ranges)

    @property
    def negatives(self) -> int:
        return sum(r.neg for r in self.ranges)

    def auc(self) -> float | None:
        """Area under the ROC curve, ties counting half; None unless both classes occur."""
        twice_area = above = 0
        for r in self.ranges:
            twice_area += int(r.twice) + 2 * above * r.neg
            above += r.pos
        if not self.positives or not self.negatives:
            return None
        auc = twice_area / (2 * self.positives * self.negatives)
        if auc < AUC_WARNING_LEVEL:
            level = f"{AUC_WARNING_LEVEL:.2f}"
            warnings.warn(f"low AUC: {auc:.4f} is below {level}", stacklevel=2)
        return auc

    def _beside(self) -> DataFrame:
        """Per range the counts above it, and those of the first score of the next range."""
        rows, above_pos, above_neg = [], 0, 0
        for r, below in zip(self.ranges, [*self.ranges[1:], None]):
            first = (below.top_pos, below.top_neg) if below else (None, None)
            rows.append((r.r, above_pos, above_neg, *first))
            above_pos, above_neg = above_pos + r.pos, above_neg + r.neg
        schema = "r int, above_pos long, above_neg long, first_pos long, first_neg long"
        return self.groups.sparkSession.createDataFrame(rows, schema)

    def curve(self, drop_intermediate: bool = True) -> DataFrame:
        """Points (threshold, fpr, tpr) from the strictest threshold down, from infinity.

        Points in the middle of a straight step are left out by default, as they do not bend
        the curve; the strictest and the loosest threshold always stay. A rate whose class is
        absent is null.
        """
        # One row per shuffle partition at most.
        points = self.groups.join(F.broadcast(self._beside()), "r").select(
            F.col("s").alias("threshold"),
            "pos",
            "neg",
            (F.col("fps") + F.col("above_neg")).alias("fps"),
            (F.col("tps") + F.col("above_pos")).alias("tps"),
            F.coalesce("next_pos", "first_pos").alias("next_pos"),
            F.coalesce("next_neg", "first_neg").alias("next_neg"),
        )
        if drop_intermediate:
            bends = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
            first = F.col("fps") + F.col("tps") == F.col("pos") + F.col("neg")
            points = points.filter(first | F.col("next_pos").isNull() | bends)
        origin = {"threshold": math.inf, "fps": 0, "tps": 0}
        start = one_row(
            self.groups.sparkSession, origin, "threshold double, fps bigint, tps bigint"
        )
        return start.unionByName(points.select("threshold", "fps", "tps")).select(
            "threshold",
            F.try_divide(F.col("fps").cast("double"), F.lit(float(self.negatives))).alias("fpr"),
            F.try_divide(F.col("tps").cast("double"), F.lit(float(self.positives))).alias("tpr"),
        )

    def histogram(self, spans: list[Span], bins: int = HISTOGRAM_BINS) -> DataFrame:
        """:func:`error_histogram` from the counts per score."""
        classes = F.array(
            *[F.struct(F.lit(y).alias("y"), F.col(n).alias("n")) for y, n in ((0, "neg"), (1, "pos"))]
        )
        counted = self.groups.select("s", F.explode(classes).alias("c")).select("s", "c.*")
        return _binned(counted.filter("n > 0"), spans, bins)


def rank_scores(df: DataFrame, ranges: int | None = None) -> RankedScores:
    """Group the rows by score; ties collapse before the shuffle.

    The groups are cut into ranges of the descending order by Spark's range partitioning, the
    number of a partition being its range; running sums are taken inside ranges, so no task sorts
    the whole table, and the totals of the ranges, one row for each, do the rest. The groups are
    written once; ``ranges`` sets their number, else it is Spark's.
    """
    scratch = Scratch(df.sparkSession)
    scored = df.select(F.col(LABEL).alias("y"), F.col(SCORE).cast("double").alias("s"))
    # Adding zero joins -0.0 to 0.0.
    groups = (
        scored.filter(F.col("s").isNotNull() & ~F.isnan("s"))
        .groupBy((F.col("s") + F.lit(0.0)).alias("s"))
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    )
    cut = [ranges, F.desc("s")] if ranges else [F.desc("s")]
    order = Window.partitionBy("r").orderBy(F.desc("s"))
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    ranged = groups.repartitionByRange(*cut).withColumn("r", F.spark_partition_id())
    table = scratch.keep(
        ranged.select(
            "*",
            F.sum("pos").over(until).alias("tps"),
            F.sum("neg").over(until).alias("fps"),
            F.lead("pos").over(order).alias("next_pos"),
            F.lead("neg").over(order).alias("next_neg"),
        ),
        "ranked",
    )
    # Twice the area inside a range is at most rows**2, beyond 64 bits in large tables.
    whole = "decimal(19,0)"
    twice = (F.col("tps") * 2 - F.col("pos")).cast(whole) * F.col("neg").cast(whole)
    totals = table.groupBy("r").agg(
        F.sum(twice).alias("twice"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.max_by("pos", "s").alias("top_pos"),
        F.max_by("neg", "s").alias("top_neg"),
    )
    return RankedScores(table, sorted(totals.collect(), key=lambda r: r.r), scratch)


def auc_roc(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row: AUC (null with one class) and whether it is below the warning level."""
    ranked = rank_scores(df, ranges)
    auc = ranked.auc()
    ranked.scratch.drop()
    found = {"auc_roc": auc, "below_warning": None if auc is None else auc < AUC_WARNING_LEVEL}
    return one_row(df.sparkSession, found, "auc_roc double, below_warning boolean")


def roc_curve(
    df: DataFrame, drop_intermediate: bool = True, ranges: int | None = None
) -> DataFrame:
    """ROC points of rows with ``y`` and ``mse``; see :meth:`RankedScores.curve`."""
    return rank_scores(df, ranges).curve(drop_intermediate)


def error_histogram(df: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of the score per class, each class over its own range.

    Rows: class label, bin, lower and upper edge, records. The last bin is closed; a class
    whose scores are all equal gets a range of one unit around them; an absent class has no rows.
    Bins span the finite scores; infinite ones, if any, are counted in a bin of their own, -1 or
    ``bins``, whose edges are infinite.
    """
    scored = df.select(F.col(LABEL).alias("y"), F.col(SCORE).cast("double").alias(SCORE))
    measures = zip(("lo", "hi", "below", "above"), _span_measures(F.lit(True)))
    valid = scored.filter(F.col(SCORE).isNotNull() & ~F.isnan(SCORE))
    found = valid.groupBy("y").agg(*[m.alias(name) for name, m in measures]).collect()
    spans = [Span(r.y, r.lo, r.hi, r.below, r.above) for r in found]
    counted = valid.select("y", F.col(SCORE).alias("s"), F.lit(1).cast("bigint").alias("n"))
    return _binned(counted, spans, bins)


def _binned(counted: DataFrame, spans: list[Span], bins: int) -> DataFrame:
    """Bins of rows (y, s, n), each standing for ``n`` scores; the spans cover them."""
    scored = counted.filter(F.abs("s") < math.inf)
    schema = "label int, bin int, lower double, upper double, records bigint"
    endless = [
        (int(row.y), place, edge, edge, n)
        for row in spans
        for place, edge, n in ((-1, -math.inf, row.below), (bins, math.inf, row.above))
        if n
    ]
    edges: dict[int, list[float]] = {}
    for row in spans:
        if row.lo is None:
            continue
        lo, hi = (row.lo, row.hi) if row.lo < row.hi else (row.lo - 0.5, row.hi + 0.5)
        width = (hi - lo) / bins
        edges[row.y] = [lo + i * width for i in range(bins)] + [hi]
    spark = counted.sparkSession
    beyond = spark.createDataFrame(endless, schema)
    if not edges:
        return beyond

    def by_class(value) -> Column:
        picked = None
        for y, at in edges.items():
            branch = value(at)
            picked = F.when(F.col("y") == y, branch) if picked is None else picked.when(
                F.col("y") == y, branch
            )
        return picked

    guess = by_class(
        lambda at: F.floor((F.col("s") - at[0]) * (bins / (at[-1] - at[0]))).cast("int")
    )
    edge = by_class(lambda at: F.lit(at))
    # The division may land one bin off next to an edge; the edges decide.
    first = F.least(guess, F.lit(bins - 1))
    lowered = F.when(F.col("s") < F.element_at("e", F.col("b") + 1), F.col("b") - 1).otherwise(
        F.col("b")
    )
    raised = F.when(
        (F.col("b") < bins - 1) & (F.col("s") >= F.element_at("e", F.col("b") + 2)),
        F.col("b") + 1,
    ).otherwise(F.col("b"))
    placed = (
        scored.withColumn("b", first)
        .withColumn("e", edge)
        .withColumn("b", lowered)
        .withColumn("b", raised)
    )
    counted = placed.groupBy(F.col("y").cast("int").alias("y"), "b").agg(
        F.sum("n").alias("count")
    )
    grid = spark.createDataFrame(
        [(int(y), i, at[i], at[i + 1]) for y, at in edges.items() for i in range(bins)],
        "label int, bin int, lower double, upper double",
    )
    # At most one row per class and bin on either side.
    joined = grid.join(
        F.broadcast(counted), (grid.label == counted.y) & (grid.bin == counted.b), "left"
    )
    records = F.coalesce("count", F.lit(0)).cast("bigint").alias("records")
    binned = joined.select("label", "bin", "lower", "upper", records)
    return binned.unionByName(beyond) if endless else binned
