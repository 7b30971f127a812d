"""Treatment classification with MLlib.

Flags are encoded with CASE expressions, features assembled and min-max scaled
(the scaler is one aggregation pass), a random forest is tuned with a
train/validation search, and predictions and areas under ROC are returned as
tables rather than printed or collected.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, MinMaxScaler, MinMaxScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from carelake.functions.columns import flag
from carelake.operators import forest as trees
from carelake.operators.joins import join_small, stored
from carelake.operators.places import with_running_sum
from carelake.operators.stats import auc_rank_sum
from carelake.session import scratch_dir, ship_package

# The search space of the original model selection.
GRID_BOOTSTRAP = [True, False]
GRID_MAX_DEPTH = [2, 5, 10, 20]
GRID_NUM_TREES = [50, 100, 150]
SEED = 100
MAX_BINS = 64
TRAIN_RATIO = 0.8

FIT_ROWS = 4000  # rows of a ``fit_sample``, if its caller names no number
FIT_PARTITIONS = 4
FIT_CELLS = 2_000_000  # of more cells the search is MLlib's, on the rows
TREES_PER_TASK = 10

_CELL, _VALUES = "__cell", "all_values"
_MAX_CELLS = 1 << 53  # a cell's number is put together in doubles
_ONE = 1 << 44  # shares are added as whole numbers: the same sum in any order


def encode_flags(df: DataFrame, flags: dict[str, tuple[str, object]], drop_sources: bool = True) -> DataFrame:
    """``{flag_name: (source_column, value)}`` -> 0/1 columns.

    When a flag takes the name of its source column, the source is replaced;
    other sources are dropped when ``drop_sources`` is set.
    """
    tmp = {f"__{name}": flag(src, value) for name, (src, value) in flags.items()}
    out = df.withColumns(tmp)
    if drop_sources:
        out = out.drop(*{src for src, _ in flags.values()})
    for name in flags:
        out = out.withColumnRenamed(f"__{name}", name)
    return out


def scale_features(df: DataFrame, features: list[str], extra: list[str] | None = None,
                   handle_invalid: str = "error", fit_on: DataFrame | None = None) -> DataFrame:
    """features -> ``features`` vector -> ``scaled_features`` in [0, 1] ->
    ``all_features`` (scaled vector + ``extra`` columns).

    The scaler is fitted on ``fit_on`` (default: all rows, as in the original
    notebook; pass the training rows to keep test rows out of the fit). A
    constant feature scales to 0.5. NULL features raise unless
    ``handle_invalid`` is "skip" or "keep". Where the fit saw all rows and no value of
    theirs is missing, ``all_values`` is an array of the same numbers as ``all_features``,
    made by built-in expressions: cheaper for steps that need no vector.
    """
    extra = list(extra or [])
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid=handle_invalid)
    assembled = asm.transform(df)
    scaler = MinMaxScaler(inputCol="features", outputCol="scaled_features")
    bounds = _bounds(df if fit_on is None else fit_on, features, extra if fit_on is None else [])
    model = scaler.fit(asm.transform(bounds if bounds is not None else df if fit_on is None else fit_on))
    scaled = model.transform(assembled)
    asm2 = VectorAssembler(inputCols=["scaled_features"] + extra, outputCol="all_features",
                           handleInvalid=handle_invalid)
    out = asm2.transform(scaled)
    if bounds is None or fit_on is not None:
        return out
    return out.withColumn(_VALUES, F.array(*_scaled(model, features), *[F.col(c).cast("double") for c in extra]))


def _bounds(df: DataFrame, features: list[str], extra: list[str]) -> DataFrame | None:
    """Two rows, the minima and the maxima of ``features``: a scaler's fit on them is its fit on all rows. None
    if there is no row, a value of ``features`` or ``extra`` is missing, or one of them is no number."""
    if not all(isinstance(df.schema[c].dataType, NumericType) for c in [*features, *extra]):
        return None
    x = [F.col(c).cast("double") for c in [*features, *extra]]
    missing = reduce(or_, [v.isNull() | F.isnan(v) for v in x])
    got = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing"),
                 *[f(v).alias(f"{n}{i}") for i, v in enumerate(x[:len(features)]) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if not got["n"] or got["missing"]:
        return None
    rows = [tuple(got[f"{n}{i}"] for i in range(len(features))) for n in ("lo", "hi")]
    return df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` double" for c in features))


def _scaled(model: MinMaxScalerModel, features: list[str]) -> list[Column]:
    """What the scaler makes of each feature, as built-in expressions: its arithmetic, step by step."""
    low, high = model.getMin(), model.getMax()
    out = []
    for c, lo, hi in zip(features, model.originalMin.toArray().tolist(), model.originalMax.toArray().tolist()):
        x, by = F.col(c).cast("double"), (high - low) / (hi - lo) if hi != lo else 0.0
        out.append((x - F.lit(lo)) * F.lit(by) + F.lit(low) if by else F.lit((low + high) / 2))
    return out


def _below(share: float, key: list[str], seed: int) -> Column:
    """Whether the row key's number in [0, 1) is below ``share``. The number: the first 8 hex digits of the md5 of
    seed and key, joined by ``|``, over 2^32 (any SQL engine can compute it); hex digits compare as they are."""
    least = math.ceil(share * (1 << 32))
    if least >= 1 << 32:
        return F.lit(True)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.substring(F.md5(text), 1, 8) < F.lit(f"{max(least, 0):08x}")


def hash_split(df: DataFrame, key: list[str], ratio: float = TRAIN_RATIO, seed: int = SEED) -> DataFrame:
    """Adds ``split`` = train/test from a hash of the row key: the same row lands
    in the same split however the data is partitioned or re-read."""
    return df.withColumn("split", F.when(_below(ratio, key, seed), F.lit("train")).otherwise(F.lit("test")))


def fit_sample(train: DataFrame, key: list[str], rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """About ``rows`` training rows to fit on (all, if fewer), chosen by a hash of the key.

    They lie in ``FIT_PARTITIONS`` hash partitions, each in key order, so a fit (which
    draws its bags per partition) is the same on any cluster. This bounds the labelled rows
    used to fit; predictions cover every row.
    """
    share = min(1.0, rows / max(train.count(), 1))
    return (train.where(_below(share, key, seed + 1)).repartition(FIT_PARTITIONS, *key).sortWithinPartitions(*key))


def scale_columns(df: DataFrame, features: list[str], prefix: str = "scaled_", digits: int | None = 6) -> DataFrame:
    """``features`` scaled to [0, 1] as columns (no vectors): one aggregation for all
    minima and maxima, then built-in expressions. A constant feature scales to 0.5."""
    got = df.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for i, c in enumerate(features):
        lo, hi = got[f"lo{i}"], got[f"hi{i}"]
        x = F.lit(0.5) if lo is None or lo == hi else (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo)
        out[prefix + c] = F.round(x, digits) if digits is not None else x
    return df.withColumns(out)


def forest(label: str, features: str = "all_features") -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features)


def evaluator(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def param_grid(rf: RandomForestClassifier, bootstrap=None, max_depth=None, num_trees=None,
               seed: int = SEED, max_bins: int = MAX_BINS):
    return (ParamGridBuilder().baseOn({rf.seed: seed, rf.maxBins: max_bins})
            .addGrid(rf.bootstrap, bootstrap if bootstrap is not None else GRID_BOOTSTRAP)
            .addGrid(rf.maxDepth, max_depth if max_depth is not None else GRID_MAX_DEPTH)
            .addGrid(rf.numTrees, num_trees if num_trees is not None else GRID_NUM_TREES)
            .build())


def tune_forest(train: DataFrame, label: str, features: str = "all_features", grid_kwargs: dict | None = None,
                ratio: float = TRAIN_RATIO, seed: int = SEED, parallelism: int = 4,
                key: list[str] | None = None) -> TrainValidationSplitModel:
    """Train/validation search over the forest grid; the best set is refit on all
    training rows.

    With ``key`` rows are dealt to training and validation by a hash of it, and the search runs on the counts of all
    rows per cell of the features' bins (``_tune_on_cells``): one result on any partitioning. MLlib's own
    search, on the rows, is left for what has no such counts: categories, values that are missing or not finite, labels
    other than 0 and 1 or only one of them, more than ``FIT_CELLS`` cells, bins too many to number.
    """
    rf = forest(label, features)
    grid = param_grid(rf, **(grid_kwargs or {}))
    tvs = TrainValidationSplit(estimator=rf, estimatorParamMaps=grid,
                               evaluator=evaluator(label), trainRatio=ratio, seed=seed,
                               parallelism=max(1, min(parallelism, len(grid))))
    return (_tune_on_cells(tvs, train, key) if key else None) or tvs.fit(train)


def exact_cuts(df: DataFrame, features: str, max_bins: int) -> list[list[float]] | None:
    """Cuts per feature, at most ``max_bins - 1``, from the values of all rows: between all neighbours if a feature has
    at most ``max_bins`` values, else between those next to the multiples of 1 / ``max_bins`` of the rows.
    None if there is no row or a value is not finite."""
    values = F.col(_VALUES) if _VALUES in df.columns else vector_to_array(features)
    counts = stored(df.select(F.posexplode(values).alias("i", "x")).groupBy("i", "x").agg(F.count(F.lit(1)).alias("n")))
    finite = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < math.inf)
    totals = {r["i"]: r for r in counts.groupBy("i").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"),
                                                         F.count_if(~finite).alias("odd")).collect()}  # a row per feature
    if not totals or any(r["odd"] for r in totals.values()):
        return None
    few = [i for i, r in totals.items() if r["values"] <= max_bins]
    ends: list[set[float]] = [set() for _ in totals]  # the values that end a bin
    for i, x in counts.where(F.col("i").isin(few)).select("i", "x").collect():
        ends[i].add(x)
    if len(few) < len(totals):
        many = with_running_sum(counts.where(~F.col("i").isin(few)), ["i", "x"], {"upto": "n"})
        n, start = totals[0]["rows"], F.lit(None).cast("bigint")  # each feature has a value in every row
        for before, i in enumerate(sorted(set(totals) - set(few))):
            start = F.when(F.col("i") == i, F.lit(before * n)).otherwise(start)
        part = (F.col("upto") - start).cast("double") * max_bins / n
        k = F.least(F.greatest(F.round(part), F.lit(1.0)), F.lit(max_bins - 1.0))
        near = many.where(part < max_bins).select("i", "x", k.alias("k"), F.abs(part - k).alias("off"))
        for i, _, at in near.groupBy("i", "k").agg(F.min(F.struct("off", "x")).alias("at")).collect():  # max_bins rows per feature
            ends[i].add(at["x"])
    # A cut lies midway between the value that ends a bin and the next value that occurs.
    known = [sorted(e) for e in ends]
    after = F.lit(None).cast("int")
    for i, e in enumerate(known):
        after = F.when(F.col("i") == i, F.size(F.filter(F.array(*[F.lit(x) for x in e]), lambda x: x < F.col("x")))).otherwise(after)
    nexts = {(r["i"], r["b"]): r["x"] for r in counts.groupBy("i", after.alias("b")).agg(F.min("x").alias("x")).collect()}
    cuts = [[(x, nexts.get((i, k + 1))) for k, x in enumerate(e)] for i, e in enumerate(known)]
    return [[min(max(x + (y - x) / 2, x), math.nextafter(y, -math.inf)) for x, y in c if y is not None] for c in cuts]


def _has_categories(df: DataFrame, features: str) -> bool:
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return bool({"nominal", "binary"} & set(attrs))


def _cells_of(train: DataFrame, label: str, features: str, cuts: list[list[float]], key: list[str], ratio: float, seed: int) -> trees.Cells | None:
    """The rows of ``train`` counted per cell, on the driver: ``FIT_CELLS`` bounds them."""
    if math.prod(len(c) + 2 for c in cuts if c) >= _MAX_CELLS:
        return None
    fit, y = F.col("__fit"), F.col(label)
    rows = _with_cell(train, features, cuts).select(_CELL, label, _below(ratio, key, seed + 1).alias("__fit"))
    counts = stored(rows.groupBy(_CELL).agg(
        *[F.count_if(of & (y == v)).alias(f"{n}{v}") for n, of in (("fit", fit), ("check", ~fit)) for v in (0, 1)],
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("odd")))
    n, odd, *both = counts.agg(F.count(F.lit(1)), F.sum("odd"), F.sum("fit0"), F.sum("fit1")).first()
    if n > FIT_CELLS or odd or not all(both):
        return None
    got = counts.toArrow()
    number, *per = (got[c].to_numpy() for c in (_CELL, "fit0", "fit1", "check0", "check1"))
    return trees.cells(cuts, number, np.array(per[:2]), np.array(per[2:]))


def _subset(num_features: int, num_trees: int) -> int:
    """Features looked at per node, as the classifier's "auto": the root of all, but all of them for a single tree."""
    return num_features if num_trees == 1 else math.ceil(math.sqrt(num_features))


def _tune_on_cells(tvs: TrainValidationSplit, train: DataFrame, key: list[str]) -> TrainValidationSplitModel | None:
    """The search of ``tvs`` on the counts of all rows per cell; None if they cannot be had.

    Each task grows trees on the broadcast counts. A tree is grown once for all the depths, and the forests of one
    kind of bag share their trees (``operators.forest``): every parameter set is scored, by the exact area under
    ROC of its forest on the validation rows. The trees of the best set are grown again on all rows and become an MLlib model.
    """
    spark, rf, ratio = train.sparkSession, tvs.getEstimator(), tvs.getTrainRatio()
    label, features = rf.getLabelCol(), rf.getFeaturesCol()
    sets = [{p.name: v for p, v in pm.items()} for pm in tvs.getEstimatorParamMaps()]
    if _has_categories(train, features) or len({(p["seed"], p["maxBins"]) for p in sets}) > 1:
        return None
    cuts = exact_cuts(train, features, sets[0]["maxBins"])
    cells = _cells_of(train, label, features, cuts, key, ratio, tvs.getSeed()) if cuts and any(cuts) else None
    if cells is None:
        return None
    ship_package(spark)
    shared = spark.sparkContext.broadcast(cells)
    try:
        scores = _grid_scores(spark, shared, sets, len(cuts))
        best = max(range(len(sets)), key=lambda i: scores[i])
        model = _grown(spark, shared, rf.copy(tvs.getEstimatorParamMaps()[best]), sets[best], cuts)
    finally:
        shared.unpersist()
    return tvs._copyValues(TrainValidationSplitModel(model, scores))


def _in_tasks(spark: SparkSession, tasks: list, run, schema: str) -> DataFrame:
    """The tables that ``run(task)`` yields, one Spark task each."""
    def each(frames):
        for frame in frames:
            for i in frame["id"]:
                yield from run(tasks[i])

    return spark.range(0, len(tasks), 1, len(tasks)).mapInPandas(each, schema)


def _grid_scores(spark: SparkSession, shared, sets: list[dict], num_features: int) -> list[float]:
    """The area under ROC on the validation rows per parameter set."""
    kinds = sorted({(p["bootstrap"], _subset(num_features, p["numTrees"])) for p in sets})
    of = [kinds.index((p["bootstrap"], _subset(num_features, p["numTrees"]))) for p in sets]
    depths, seed = sorted({p["maxDepth"] for p in sets}), sets[0]["seed"]
    tasks = []
    for kind in range(len(kinds)):
        sizes = sorted({p["numTrees"] for p, k in zip(sets, of) if k == kind})
        for a, b in zip([0, *sizes], sizes):
            tasks += [(kind, b, range(x, min(x + TREES_PER_TASK, b))) for x in range(a, b, TREES_PER_TASK)]

    def run(task):
        kind, upto, numbers = task
        cells, (bootstrap, subset) = shared.value, kinds[kind]
        seen = np.flatnonzero(cells.check.sum(axis=0))
        bins = np.ascontiguousarray(cells.bins[:, seen])
        sums = np.zeros((len(depths), len(seen)), np.int64)
        for number in numbers:
            tree = trees.grow(cells.bins, cells.fit, cells.width, depths[-1], subset, bootstrap, seed, number)
            for s, share in zip(sums, trees.shares(tree, bins, depths)):
                s += np.rint(share * _ONE).astype(np.int64)
        yield pd.DataFrame({"kind": kind, "upto": upto, "cell": seen, "neg": cells.check[0, seen], "pos": cells.check[1, seen],
                            **{f"s{d}": s for d, s in zip(depths, sums)}})

    parts = _in_tasks(spark, tasks, run, "kind int, upto int, cell bigint, neg bigint, pos bigint, " + ", ".join(f"s{d} bigint" for d in depths))
    wide = stored(parts.groupBy("kind", "cell").agg(
        F.max("neg").alias("neg"), F.max("pos").alias("pos"),
        *[F.sum(F.when(F.col("upto") <= n, F.col(f"s{d}"))).alias(f"s{d}_{n}") for d, n in sorted({(p["maxDepth"], p["numTrees"]) for p in sets})]))
    each = F.array(*[F.struct(F.lit(i).alias("set"), F.lit(k).alias("of"), F.col(f"s{p['maxDepth']}_{p['numTrees']}").alias("score"))
                     for i, (p, k) in enumerate(zip(sets, of))])
    rows = wide.select("kind", F.explode(F.filter(each, lambda e: e["of"] == F.col("kind"))).alias("e"), F.explode(F.array(
        F.struct(F.lit(0).alias("y"), F.col("neg").alias("n")), F.struct(F.lit(1).alias("y"), F.col("pos").alias("n")))).alias("l"))
    got = auc_rank_sum(rows.select("e.set", "e.score", "l.y", "l.n").where("n > 0"), "score", "y", by="set", weight="n")
    area = {r["set"]: r["auc"] for r in got.collect()}  # a row per parameter set
    return [0.0 if area.get(i) is None else area[i] for i in range(len(sets))]


def _grown(spark: SparkSession, shared, rf: RandomForestClassifier, params: dict, cuts: list[list[float]]) -> RandomForestClassificationModel:
    """The forest of one parameter set, fitted on all rows, as a model of MLlib: tasks write its nodes in the form in
    which MLlib stores a model, around the metadata of a model that MLlib fitted on two rows with the same parameters."""
    n, depth, seed, bootstrap = (params[x] for x in ("numTrees", "maxDepth", "seed", "bootstrap"))
    subset = _subset(len(cuts), n)

    def run(numbers):
        cells = shared.value
        rows = cells.fit + cells.check
        for number in numbers:
            tree = trees.grow(cells.bins, rows, cells.width, depth, subset, bootstrap, seed, number)
            nodes, leaf, left = trees.kept(tree, depth)
            count, feature, split = tree.count[nodes], np.where(leaf, -1, tree.feature[nodes]), tree.split[nodes]
            total = np.maximum(count.sum(axis=1), 1.0)
            yield pd.DataFrame({
                "tree": number, "id": np.arange(len(nodes)), "n0": count[:, 0], "n1": count[:, 1],
                "impurity": 1.0 - (count[:, 0] / total) ** 2 - (count[:, 1] / total) ** 2, "gain": np.where(leaf, -1.0, tree.gain[nodes]),
                "left_child": left, "right_child": np.where(leaf, -1, left + 1), "feature": feature,
                "threshold": [math.nan if f < 0 else cells.cuts[f][s] for f, s in zip(feature, split)]})

    tasks = [range(x, min(x + TREES_PER_TASK, n)) for x in range(0, n, TREES_PER_TASK)]
    nodes = _in_tasks(spark, tasks, run, "tree int, id int, n0 double, n1 double, impurity double, gain double, "
                                         "left_child int, right_child int, feature int, threshold double")
    two = spark.createDataFrame([(Vectors.dense([float(y)] * len(cuts)), y) for y in (0, 1)], ["x", "y"])
    like, path = scratch_dir(spark, "forest-like"), scratch_dir(spark, "forest")
    two = two.select(F.col("x").alias(rf.getFeaturesCol()), F.col("y").alias(rf.getLabelCol()))
    rf.fit(two.coalesce(1)).write().save(like)
    spark.read.text(f"{like}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.read.parquet(f"{like}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    is_leaf = F.col("feature") < 0
    split = F.struct(F.col("feature").alias("featureIndex"),
                     F.when(is_leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    node = F.struct("id", F.when(F.col("n1") > F.col("n0"), 1.0).otherwise(0.0).alias("prediction"), "impurity",
                    F.array("n0", "n1").alias("impurityStats"), (F.col("n0") + F.col("n1")).cast("bigint").alias("rawCount"), "gain",
                    F.col("left_child").alias("leftChild"), F.col("right_child").alias("rightChild"), split.alias("split"))
    nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def scoring_model(model):
    """The model to score with: the best forest without its training summary.

    A fitted forest keeps a training summary that holds the session; once the
    session has used an ``Observation`` (row counters on writes) that session
    can no longer be serialised into tasks. ``copy()`` drops the summary.
    """
    best = model.bestModel if isinstance(model, TrainValidationSplitModel) else model
    return best.copy()


def grid_table(spark: SparkSession, model: TrainValidationSplitModel) -> DataFrame:
    """One row per parameter set: ``(bootstrap, max_depth, num_trees, metric,
    score, is_best)``; ``metric`` names the search's evaluator metric."""
    rows = []
    metrics = model.validationMetrics
    metric_name = model.getEvaluator().getMetricName()
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    for i, (pm, m) in enumerate(zip(model.getEstimatorParamMaps(), metrics)):
        p = {k.name: v for k, v in pm.items()}
        rows.append((bool(p["bootstrap"]), int(p["maxDepth"]), int(p["numTrees"]), metric_name, float(m),
                     i == best))
    return spark.createDataFrame(rows, "bootstrap boolean, max_depth int, num_trees int, metric string, "
                                       "score double, is_best boolean")


def cut_points(forest) -> list[list[float]] | None:
    """The thresholds of a forest per feature, ascending (at most ``maxBins - 1`` each, whatever the rows of its
    fit); None if a split is on categories."""
    text = forest.toDebugString
    if " in {" in text:
        return None
    cuts: list[set[float]] = [set() for _ in range(forest.numFeatures)]
    for i, t in re.findall(r"If \(feature (\d+) <= ([^)\s]+)\)", text):
        cuts[int(i)].add(float(t))
    return [sorted(c) for c in cuts]


def _grid(forest) -> list[list[float]] | None:
    """The forest's cuts, if their cells can be numbered."""
    cuts = cut_points(forest)
    return cuts if cuts is not None and math.prod(len(c) + 2 for c in cuts if c) < _MAX_CELLS else None


def _with_cell(df: DataFrame, features: str, cuts: list[list[float]]) -> DataFrame:
    """``df`` with the number of each row's cell: a digit per feature the forest looks at, which tells the cuts that
    the value lies between (one digit more for NaN)."""
    used = [i for i, c in enumerate(cuts) if c]
    if not used:
        return df.withColumn(_CELL, F.lit(0).cast("bigint"))
    values = F.col(_VALUES) if _VALUES in df.columns else vector_to_array(features)
    # A split sends x <= t left, a bucket begins with its bound: that is the next number after t.
    bins = Bucketizer(splitsArray=[[-math.inf, *[math.nextafter(t, math.inf) for t in cuts[i]], math.inf] for i in used],
                      inputCols=[f"__v{i}" for i in used], outputCols=[f"__b{i}" for i in used], handleInvalid="keep")
    cut = bins.transform(df.withColumns({f"__v{i}": F.get(values, i) for i in used}))
    cell, radix = F.lit(0.0), 1
    for i in used:
        cell, radix = cell + F.col(f"__b{i}") * F.lit(float(radix)), radix * (len(cuts[i]) + 2)
    return cut.withColumn(_CELL, cell.cast("bigint"))


def _cell_vector(cuts: list[list[float]]) -> Column:
    """A vector that lies in the cell: per feature the cut that ends its interval, or a number beyond the last."""
    values, radix = [], 1
    for c in cuts:
        if not c:
            values.append(F.lit(0.0))
            continue
        ends = F.array(*[F.lit(x) for x in [*c, math.nextafter(c[-1], math.inf), math.nan]])
        values.append(F.get(ends, F.expr(f"CAST(({_CELL} DIV {radix}) % {len(c) + 2} AS INT)")))
        radix *= len(c) + 2
    return array_to_vector(F.array(*values))


def _scores(best, df: DataFrame, *columns: str) -> DataFrame:
    return best.transform(df).select(*columns, "prediction", vector_to_array("probability")[1].alias("probability_1"))


def scored_cells(model, df: DataFrame, by: list[str]) -> DataFrame:
    """``by…, n, prediction, probability_1, __cell``, stored: the rows counted per values of ``by`` and cell, with the
    forest's answer for the cell.

    A forest asks on which side of its thresholds the features lie, and nothing else: all rows of a cell of the
    grid of thresholds get one answer. Rows are counted per cell (map-side), and each cell that occurs is
    scored once, by the model, wherever in the grid the rows are: ``maxBins`` and the features bound them, not
    the rows. A forest without such a grid (splits on categories, too many features) scores every row once.
    """
    best = scoring_model(model)
    cuts = _grid(best)
    if cuts is None:
        return stored(_scores(best, df, *by).groupBy(*by, "prediction", "probability_1").agg(F.count(F.lit(1)).alias("n")))
    features, spark = best.getFeaturesCol(), df.sparkSession
    counts = stored(_with_cell(df, features, cuts).groupBy(*by, _CELL).agg(F.count(F.lit(1)).alias("n")))
    # A few cells fill a task of their own with work: not so few tasks as their bytes would make.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = counts.select(_CELL).distinct().repartition(tasks).withColumn(features, _cell_vector(cuts))
    return stored(join_small(counts, _scores(best, cells, _CELL), _CELL, "left"))


def predictions_table(model, df: DataFrame, key: list[str], label: str, cells: DataFrame | None = None) -> DataFrame:
    """``key…, label, prediction, probability_1`` — no vectors, no collect. Every row gets its cell's scores
    (``cells``: of ``scored_cells`` over these rows, found here if not given)."""
    best = scoring_model(model)
    cuts = _grid(best)
    if cuts is None:
        return _scores(best, df, *key, label)
    of = (scored_cells(model, df, []) if cells is None else cells).select(_CELL, "prediction", "probability_1").distinct()
    rows = _with_cell(df, best.getFeaturesCol(), cuts).select(*key, label, _CELL)
    return join_small(rows, of, _CELL, "left").drop(_CELL)


def metrics_table(model, df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Exact area under ROC and ``1 - auc`` per split: ``(split, positives, negatives, auc, error)``, from the scores of
    the cells and their rows. (The notebook printed this number as "accuracy"; it is the area under ROC.)"""
    got = auc_rank_sum(scored_cells(model, df, [split, label]), "probability_1", label, by=split, weight="n")
    return got.select(F.col(split).alias("split"), "positives", "negatives", "auc", (1 - F.col("auc")).alias("error"))
