"""Model-based selection, tree training, prediction, calibration, rules.

scikit-learn on one machine is replaced by Spark ML estimators. The long
feature table becomes one sparse vector per row (no pivot), over all feature
names. Names, coefficients and importances (one each per feature) reach the
driver; rows never do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import l1
from .boosting import boosted_importances
from .calibration import isotonic_apply, isotonic_fit
from .forest import MOST_DEPTH, forest_importances
from .tree_search import Fit, search, with_folds

KEY = "visit_occurrence_id"


def feature_names(features: DataFrame) -> list[str]:
    """All feature names, sorted: the columns of the matrix."""
    return [r["feature"] for r in features.select("feature").distinct().orderBy("feature").collect()]


def design_matrix(features: DataFrame, labels: DataFrame, names: Sequence[str], numeric: Sequence[str] = (),
                  key: str = KEY) -> DataFrame:
    """``labels`` with ``features``, a sparse 0/1 vector over ``names``, then its own ``numeric`` columns (null: 0).

    A row's present features are gathered in one array, as long as the row has
    features; the vector is built from the vocabulary on the JVM.
    """
    present = (features.where(F.col("value") > 0).groupBy(key)
               .agg(F.collect_set("feature").alias("_present")))
    return gathered_matrix(present, labels, names, numeric, key)


def gathered_matrix(present: DataFrame, labels: DataFrame, names: Sequence[str], numeric: Sequence[str] = (),
                    key: str = KEY) -> DataFrame:
    """``design_matrix`` from one row a key (key, ``_present``) whose features are in one array already.

    The vectors are made before they meet the labels, so that names are not shuffled.
    """
    vectors = CountVectorizerModel.from_vocabulary(list(names), inputCol="_present", outputCol="_sparse")
    vectors.setBinary(True)
    none = vectors.transform(labels.sparkSession.createDataFrame([([],)], "_present array<string>")).select("_sparse").scalar()
    out = labels.join(vectors.transform(present).select(key, "_sparse"), key, "left").withColumn("_sparse", F.coalesce("_sparse", none))
    kept = [c for c in labels.columns if c not in numeric]
    if not numeric:
        return out.select(*kept, F.col("_sparse").alias("features"))
    filled = out.select(*kept, "_sparse", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_n{i}")
                                            for i, c in enumerate(numeric)])
    joined = VectorAssembler(inputCols=["_sparse", *[f"_n{i}" for i in range(len(numeric))]], outputCol="features")
    return joined.transform(filled).select(*kept, "features")


def _selected(spark: SparkSession, names: Sequence[str], weights: Sequence[float], k: int,
              keep) -> DataFrame:
    rows = sorted(((n, float(w)) for n, w in zip(names, weights) if keep(float(w))),
                  key=lambda t: (-abs(t[1]), t[0]))[:k]
    return spark.createDataFrame(rows, "feature string, weight double")


def l1_select(train: DataFrame, names: Sequence[str], k: int, C: float = 0.2, threshold: float = 1e-5,
              label: str = "label", n_rows: int | None = None) -> DataFrame:
    """L4: L1-penalised logistic regression; features with |coef| > threshold, at most k."""
    n = n_rows or train.count()  # scikit-learn's C is a penalty on the sum over rows, Spark's on the mean
    model = LogisticRegression(labelCol=label, elasticNetParam=1.0, regParam=1.0 / (C * max(n, 1)),
                               maxIter=100, standardization=False).fit(train)
    coefs = model.coefficients.toArray()
    return _selected(train.sparkSession, names, coefs, k, lambda w: abs(w) > threshold)


def rfe_select(train: DataFrame, names: Sequence[str], k: int, C: float = 0.3, step: int = 10,
               label: str = "label", n_rows: int | None = None, fits: l1.L1Logistic | None = None) -> DataFrame:
    """L3: recursive elimination - refit, drop the ``step`` smallest |coef| until k remain.

    The fits share the products of the features (``fits``, made here unless given) and begin where the last one ended;
    above ``l1.MOST_FEATURES`` features, whose products no driver should hold, each is one of Spark's.
    """
    n = n_rows or train.count()
    if n and k < len(names) <= l1.MOST_FEATURES:
        shared = fits or l1.L1Logistic(train, [label], len(names), n)
        left = l1.eliminate(shared, label, names, k, 1.0 / (C * n), step)
        if fits is None:
            shared.close()
        return train.sparkSession.createDataFrame([(names[i], 1.0) for i in left], "feature string, weight double")
    current = list(range(len(names)))
    while len(current) > k:
        sliced = VectorSlicer(inputCol="features", outputCol="_f", indices=current).transform(train)
        model = LogisticRegression(labelCol=label, featuresCol="_f", elasticNetParam=1.0,
                                   regParam=1.0 / (C * max(n, 1)), maxIter=100, standardization=False).fit(sliced)
        coefs = model.coefficients.toArray()
        drop = min(step, len(current) - k)
        order = sorted(range(len(current)), key=lambda i: (abs(coefs[i]), names[current[i]]))
        dropped = set(order[:drop])
        current = [c for i, c in enumerate(current) if i not in dropped]
    return train.sparkSession.createDataFrame([(names[i], 1.0) for i in current], "feature string, weight double")


def _at_mean(spark: SparkSession, names: Sequence[str], importances, k: int) -> DataFrame:
    mean = float(importances.mean()) if len(importances) else 0.0
    return _selected(spark, names, importances, k, lambda w: w >= mean and w > 0)


def forest_select(train: DataFrame, names: Sequence[str], k: int, n_trees: int = 300, max_depth: int = 5, seed: int = 42,
                  label: str = "label") -> DataFrame:
    """Random-forest importances at or above their mean, at most k."""
    return forest_select_by_target(train, names, k, [label], n_trees, max_depth, seed)[label]


def forest_select_by_target(train: DataFrame, names: Sequence[str], k: int, labels: Sequence[str], n_trees: int = 300,
                            max_depth: int = 5, seed: int = 42) -> dict[str, DataFrame]:
    """L5 for several columns: the trees of all 0/1 columns grow in the same jobs; other columns, and trees deeper
    than ``forest.MOST_DEPTH``, are left to Spark's own forest."""
    spark = train.sparkSession
    seen = train.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(F.col(c).isin(0, 1), F.lit(False))).alias(f"_l{i}")
                                                     for i, c in enumerate(labels)]).first()
    plain = [c for i, c in enumerate(labels) if seen["n"] and seen[f"_l{i}"] == seen["n"] and max_depth <= MOST_DEPTH]
    found = forest_importances(train, plain, len(names), n_trees, max_depth, seed, n_rows=seen["n"]) if plain else {}
    for c in labels:
        if c not in found:
            model = RandomForestClassifier(labelCol=c, numTrees=n_trees, maxDepth=max_depth, seed=seed).fit(train)
            found[c] = model.featureImportances.toArray()
    return {c: _at_mean(spark, names, found[c], k) for c in labels}


def gbt_select(train: DataFrame, names: Sequence[str], k: int, max_iter: int = 500, max_depth: int = 6,
               label: str = "label") -> DataFrame:
    """Boosted-tree importances at or above their mean, at most k."""
    return gbt_select_by_target(train, names, k, [label], max_iter, max_depth)[label]


def gbt_select_by_target(train: DataFrame, names: Sequence[str], k: int, labels: Sequence[str], max_iter: int = 500,
                         max_depth: int = 6) -> dict[str, DataFrame]:
    """L6 for several 0/1 columns: their trees grow in the same jobs."""
    found = boosted_importances(train, labels, len(names), max_iter, max_depth)
    return {t: _at_mean(train.sparkSession, names, found[t], k) for t in labels}


@dataclass(frozen=True)
class Node:
    """A node of a fitted tree: class sums, depth, and (for an inner node) its split and children."""

    id: int
    depth: int
    stats: tuple[float, ...]
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1

    @property
    def score(self) -> float:
        return self.stats[1] / sum(self.stats) if sum(self.stats) else 0.0


def tree_nodes(model) -> list[Node]:
    """The nodes of the first tree of ``model``, a parent before its children, left before right."""
    tree = model._java_obj.trees()[0] if hasattr(model, "trees") else model._java_obj
    out: list[Node] = []

    def walk(node, depth: int) -> int:
        at = len(out)
        out.append(None)
        stats = tuple(node.impurityStats().stats())
        if node.subtreeDepth() == 0:
            out[at] = Node(at, depth, stats)
        else:
            left, right = walk(node.leftChild(), depth + 1), walk(node.rightChild(), depth + 1)
            out[at] = Node(at, depth, stats, node.split().featureIndex(), node.split().threshold(), left, right)
        return at

    walk(tree.rootNode(), 0)
    return out


def truncated(nodes: Sequence[Node], depth: int) -> list[Node]:
    """The tree that a fit with maximal depth ``depth`` gives, from that of a deeper fit: splits do not depend on
    what is below them. As in a fit, sibling leaves that predict the same class become one leaf."""
    out: list[Node] = []

    def walk(i: int) -> int:
        node, at = nodes[i], len(out)
        leaf = replace(node, id=at, feature=-1, threshold=0.0, left=-1, right=-1)
        out.append(leaf)
        if node.left >= 0 and node.depth < depth:
            left, right = walk(node.left), walk(node.right)
            a, b = out[left], out[right]
            if a.left < 0 and b.left < 0 and _class(a) == _class(b):
                del out[at + 1:]
            else:
                out[at] = replace(node, id=at, left=left, right=right)
        return at

    walk(0)
    return out


def _class(node: Node) -> int:
    return max(range(len(node.stats)), key=lambda c: (node.stats[c], -c))


def _auc(counts: dict[float, tuple[float, float]]) -> float:
    """ROC AUC of (negatives, positives) by score; 0.5 without one of the classes."""
    area = below = positives = 0.0
    for s in sorted(counts):
        neg, pos = counts[s]
        area += pos * (below + neg / 2)
        below += neg
        positives += pos
    return area / (below * positives) if below * positives else 0.5


def depth_scores(model, rows: DataFrame, depths: Sequence[int], label: str = "label") -> dict[int, float]:
    """ROC AUC on ``rows`` of the tree cut at each of ``depths``, from one pass that counts classes per leaf."""
    nodes = tree_nodes(model)
    leaves = [n.id for n in nodes if n.left < 0]  # in the order in which the model numbers them
    leaf = vector_to_array(F.col("_leaf"))[0].cast("int") if hasattr(model, "trees") else F.col("_leaf").cast("int")
    counted = (model.copy().setLeafCol("_leaf").transform(rows).groupBy(leaf.alias("leaf"))
               .agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).collect())
    seen = {leaves[r["leaf"]]: (r["neg"], r["pos"]) for r in counted}  # a row for each leaf
    return _cut_scores(nodes, seen, depths)


def _cut_scores(nodes: Sequence[Node], seen: dict[int, tuple[float, float]], depths: Sequence[int]) -> dict[int, float]:
    """ROC AUC of the tree cut at each of ``depths``, from the (negatives, positives) of its leaves."""
    parent = {c: n.id for n in nodes if n.left >= 0 for c in (n.left, n.right)}
    out = {}
    for depth in depths:
        cut = truncated(nodes, depth)
        home = _places(nodes, cut)
        sums: dict[float, tuple[float, float]] = {}
        for i, (neg, pos) in seen.items():
            while i not in home:
                i = parent[i]
            s = cut[home[i]].score
            sums[s] = (sums.get(s, (0, 0))[0] + neg, sums.get(s, (0, 0))[1] + pos)
        out[depth] = _auc(sums)
    return out


def fitted_nodes(fit: Fit) -> tuple[list[Node], dict[int, int]]:
    """The nodes of a tree of the search, sibling leaves of one class apart, and their places by heap number."""
    out: list[Node] = []
    home: dict[int, int] = {}

    def walk(node: int, depth: int) -> int:
        at = home[node] = len(out)
        out.append(Node(at, depth, tuple(map(float, fit.nodes[node]))))
        if node in fit.splits:
            left, right = walk(2 * node, depth + 1), walk(2 * node + 1, depth + 1)
            out[at] = Node(at, depth, out[at].stats, *fit.splits[node], left, right)
        return at

    walk(1, 0)
    return out, home


def _places(nodes: Sequence[Node], cut: Sequence[Node]) -> dict[int, int]:
    """Node of the deep tree: leaf of the cut one."""
    out, todo = {}, [(0, 0)]
    while todo:
        i, j = todo.pop()
        if cut[j].left < 0:
            out[i] = j
        else:
            todo += [(nodes[i].left, cut[j].left), (nodes[i].right, cut[j].right)]
    return out


def _tree(depth: int, max_features: int, min_leaf: int, seed: int, label: str) -> RandomForestClassifier:
    """One tree: a forest of one, without bootstrap, that looks at ``max_features`` features a split."""
    return RandomForestClassifier(labelCol=label, numTrees=1, bootstrap=False, seed=seed, maxDepth=depth,
                                  featureSubsetStrategy=str(max_features), minInstancesPerNode=min_leaf)


def tree_grid(train: DataFrame, depths: Sequence[int], max_features: Sequence[int], min_leaf: Sequence[int], folds: int = 5,
              seed: int = 42, parallelism: int = 4, label: str = "label", key: str = KEY) -> list[tuple[float, int, int, int]]:
    """(mean ROC AUC over the folds, depth, max_features, min_leaf) of every grid point, the best first.

    The depths of one (max_features, min_leaf, fold) are read off one tree of
    the largest depth; the trees grow side by side (``tree_search``). Labels other
    than 0 and 1, and deeper trees, are left to fits of Spark's. Rows are dealt to
    folds by a hash of their key.
    """
    rows = with_folds(train, key, seed, folds)
    deepest = max(depths)
    points = [(f, m) for f in max_features for m in min_leaf]
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col(label).isin(0, 1), F.lit(False))).alias("plain")).first()
    if 0 < seen["n"] == seen["plain"] and deepest <= MOST_DEPTH:
        width = len(train.select("features").first()["features"])
        done = []
        for fit, leaves in search(rows, seen["n"], width, points, deepest, folds, seed, label, "_fold"):
            nodes, home = fitted_nodes(fit)
            done.append(_cut_scores(nodes, {home[leaf]: n for leaf, n in leaves.items()}, depths))
    else:
        def one(job):
            f, m, k = job
            model = _tree(deepest, f, m, seed, label).fit(rows.where(F.col("_fold") != k))
            return depth_scores(model, rows.where(F.col("_fold") == k), depths, label)

        with ThreadPool(parallelism) as pool:
            done = pool.map(one, [(f, m, k) for f, m in points for k in range(folds)], chunksize=1)
    found = []
    for i, (f, m) in enumerate(points):
        for d in depths:
            found.append((sum(x[d] for x in done[i * folds:(i + 1) * folds]) / folds, d, f, m))
    return sorted(found, key=lambda p: (-p[0], *p[1:]))


def tree_cv(train: DataFrame, depths: Sequence[int], max_features: Sequence[int], min_leaf: Sequence[int],
            folds: int = 5, seed: int = 42, parallelism: int = 4, label: str = "label", key: str = KEY):
    """The tree of the best grid point by ROC AUC (ties: the smallest tree), fitted on all of ``train``."""
    _, depth, f, m = tree_grid(train, depths, max_features, min_leaf, folds, seed, parallelism, label, key)[0]
    return _tree(depth, f, m, seed, label).fit(train)


def predict(model, df: DataFrame, key: str = KEY, label: str = "label") -> DataFrame:
    """(key, label, prediction, score = P(class 1))."""
    out = model.transform(df)
    return out.select(key, label, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("score"))


def calibrate(valid_scores: DataFrame, test_scores: DataFrame, label: str = "label") -> DataFrame:
    """Isotonic and sigmoid calibration fitted on validation scores, applied to test.

    -> (key columns of test, score, isotonic, sigmoid).
    """
    va = VectorAssembler(inputCols=["score"], outputCol="_s")
    sig = LogisticRegression(labelCol=label, featuresCol="_s", probabilityCol="_p", rawPredictionCol="_r",
                             predictionCol="_pred").fit(va.transform(valid_scores))
    out = sig.transform(va.transform(isotonic_apply(test_scores, isotonic_fit(valid_scores, "score", label))))
    return out.withColumn("sigmoid", vector_to_array("_p")[1]).drop("_s", "_p", "_r", "_pred")


def baseline_logistic(train: DataFrame, label: str = "label"):
    """Plain logistic regression beside the tree."""
    return LogisticRegression(labelCol=label, maxIter=100).fit(train)


def tree_rules(spark: SparkSession, tree_model, names: Sequence[str]) -> DataFrame:
    """Tree nodes as rows (node, depth, feature, threshold, left, right, prediction, score, leaf)."""
    rows = [(n.id, n.depth, names[n.feature] if n.left >= 0 else None, n.threshold if n.left >= 0 else None, n.left, n.right,
             _class(n), n.score, n.left < 0) for n in tree_nodes(tree_model)]
    return spark.createDataFrame(rows, "node int, depth int, feature string, threshold double, left int, right int, "
                                       "prediction int, score double, leaf boolean")


def readable_rules(rules: DataFrame, labels: DataFrame) -> DataFrame:
    """``rules`` with ``readable``, the feature's name in words; labels: (feature, readable) of some features."""
    return rules.join(labels, "feature", "left").withColumn("readable", F.coalesce("readable", "feature"))


def apply_rules(rows: DataFrame, features: DataFrame, rules: DataFrame, max_depth: int, key: str = KEY) -> DataFrame:
    """The (key, node, prediction, score) that ``rules`` lead each row of ``rows`` to.

    ``features`` is the long table (key, feature, value), 0 where a row has
    none. One step a level: the rule of the row's node (a few rows, broadcast),
    then the value of the feature it asks for.
    """
    inner = F.broadcast(rules.where(~F.col("leaf")).select("node", "feature", "threshold", "left", "right"))
    at = rows.select(key, F.lit(0).alias("node"))
    for _ in range(max_depth):
        asked = at.join(inner, "node", "left")
        at = asked.join(features.select(key, "feature", "value"), [key, "feature"], "left").select(
            key, F.when(F.col("left").isNull(), F.col("node")).when(
                F.coalesce(F.col("value").cast("double"), F.lit(0.0)) <= F.col("threshold"), F.col("left"))
            .otherwise(F.col("right")).alias("node"))
    return at.join(F.broadcast(rules.select("node", "prediction", "score")), "node").select(key, "node", "prediction", "score")
