"""The selection-to-model job: for every target column five selectors, their vote, and a tuned tree.

One matrix serves all targets: a row per target visit with its sparse feature
vector (six families and age), every target as a 0/1 column, and for each
target its split into train, validation and test. It is written once; every
fit reads it. Selection looks at all rows of a target; the tree is tuned
on the training rows over the features that the vote keeps, calibrated on the
validation rows and judged on the test rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_by_year
from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import models as ML
from ..operators import selection as SEL
from ..operators.l1 import MOST_FEATURES, L1Logistic
from ..operators.sampling import best_features, stratified_split
from ..session import materialize, written
from ..sources.files import load_targets
from .phenotype import families

KEY = "visit_occurrence_id"
#: Selectors in the order of the vote table's columns.
SELECTORS = ("xChi-2", "RFE", "Logistics", "Random Forest", "GradientBoosting")
#: Those whose trees grow for all targets in the same jobs; and one whose fits each keep the rows, so that they are made in turn.
TOGETHER = ("Random Forest", "GradientBoosting", "Logistics")


@dataclass(frozen=True)
class Sizes:
    """How much is fitted; the defaults are the job's own sizes but for the grid (README)."""

    n_features: int = 150
    forest_trees: int = 300
    boosting_rounds: int = 500
    depths: Sequence[int] = (2, 3, 4, 5)
    max_features: Sequence[int] = (50, 100, 150)
    min_leaf: Sequence[int] = (11, 13, 15)
    folds: int = 5
    seed: int = 42
    parallelism: int = 6


@dataclass
class Study:
    """The job over the role views ``r``; every step is fitted once, when it is first asked for."""

    r: object
    targets: Sequence[str] = ("fulfilled", "urgent")
    sizes: Sizes = field(default_factory=Sizes)
    _fitted: dict = field(default_factory=dict, repr=False)

    @cached_property
    def labels(self) -> DataFrame:
        """(visit, age, a 0/1 column and a split for each target)."""
        r = self.r
        age = (r.visit_occurrence.join(r.person.select("person_id", "birth_datetime"), "person_id", "left")
               .select(KEY, age_by_year("visit_end_datetime", "birth_datetime").alias("age")))
        out = load_targets(r.targets, KEY, "recorded_at").select(KEY, *self.targets).join(age, KEY, "left")
        for t in self.targets:
            out = stratified_split(out, t, [KEY], seed=self.sizes.seed).withColumnRenamed("split", f"{t}_split")
        return materialize(out)

    @cached_property
    def gathered(self) -> DataFrame:
        """(visit, items): the features of each target visit with their values. Written while the families are still dealt
        by visit, so that gathering them shuffles nothing."""
        long = FE.feature_matrix(families(self.r, self.labels))
        return written(long.groupBy(KEY).agg(F.collect_list(F.struct("feature", "value")).alias("items")))

    @cached_property
    def features(self) -> DataFrame:
        """The long feature table (visit, feature, value) of the target visits, age as one of them."""
        age = self.labels.where("age != 0").select(KEY, F.lit("age").alias("feature"), F.col("age").cast("int").alias("value"))
        return self.gathered.select(KEY, F.inline("items")).unionByName(age)

    @cached_property
    def names(self) -> list[str]:
        return [n for n in ML.feature_names(self.features) if n != "age"] + ["age"]

    @cached_property
    def matrix(self) -> DataFrame:
        """``labels`` with the sparse vector ``features`` over ``names``."""
        present = self.gathered.select(KEY, F.transform(F.filter("items", lambda x: (x["value"] > 0) & (x["feature"] != "age")),
                                                        lambda x: x["feature"]).alias("_present"))
        return materialize(ML.gathered_matrix(present, self.labels, self.names[:-1], ["age"]))

    @cached_property
    def n_rows(self) -> int:
        return self.matrix.count()

    @cached_property
    def chi2(self) -> DataFrame:
        """(target, feature, score, rank): the best by chi-square, all targets in one pass."""
        return SEL.top_k_by_target(SEL.chi2_scores_by_target(self.features, self.labels, self.targets), self.sizes.n_features)

    @cached_property
    def l1_fits(self) -> L1Logistic | None:
        """What the eliminations of all targets share; None where the features are too many for it."""
        few = self.n_rows and len(self.names) <= MOST_FEATURES
        return L1Logistic(self.matrix, self.targets, len(self.names), self.n_rows) if few else None

    def _fit(self, selector: str, targets: Sequence[str]) -> list[DataFrame]:
        """The picks of one selector: the trees of all targets grow in the same jobs, others are fitted one by one."""
        s, k = self.sizes, min(self.sizes.n_features, len(self.names))
        if selector == "GradientBoosting":
            found = ML.gbt_select_by_target(self.matrix, self.names, k, targets, max_iter=s.boosting_rounds)
            return [found[t] for t in targets]
        if selector == "Random Forest":
            found = ML.forest_select_by_target(self.matrix, self.names, k, targets, n_trees=s.forest_trees, seed=s.seed)
            return [found[t] for t in targets]
        return [self._fit_one(selector, t) for t in targets]

    def _fit_one(self, selector: str, target: str) -> DataFrame:
        s, x = self.sizes, self.matrix
        k = min(s.n_features, len(self.names))
        if selector == "xChi-2":
            return self.chi2.where(F.col("target") == target).select("feature", F.col("score").alias("weight"))
        if selector == "RFE":
            return ML.rfe_select(x, self.names, k, label=target, n_rows=self.n_rows, fits=self.l1_fits)
        return ML.l1_select(x, self.names, k, label=target, n_rows=self.n_rows)

    def selections(self, *selectors: str) -> dict[str, dict[str, DataFrame]]:
        """By target and selector the picked features (feature, weight). Fits do not depend on each other: those
        not made yet run side by side, so that the small jobs of one fill the gaps of another."""
        missing = {s: [t for t in self.targets if (s, t) not in self._fitted] for s in selectors}
        todo = [(s, ts) for s, of in missing.items() for ts in ([of] if s in TOGETHER else [[t] for t in of]) if ts]
        if todo:
            _ = self.matrix, self.n_rows, self.chi2  # made once, before the threads
            if missing.get("RFE"):
                _ = self.l1_fits
            with ThreadPool(min(len(todo), self.sizes.parallelism)) as pool:
                for (s, ts), found in zip(todo, pool.map(lambda job: self._fit(*job), todo, chunksize=1), strict=True):
                    self._fitted.update({(s, t): f for t, f in zip(ts, found, strict=True)})
            if missing.get("RFE") and self.l1_fits:
                self.l1_fits.close()
        return {t: {s: self._fitted[s, t] for s in selectors} for t in self.targets}

    def selected(self, selector: str) -> DataFrame:
        """(target, feature, weight) of one selector."""
        frames = [by[selector].select(F.lit(t).alias("target"), "feature", "weight") for t, by in self.selections(selector).items()]
        return reduce(lambda a, b: a.unionByName(b), frames)

    @cached_property
    def votes(self) -> DataFrame:
        """(target, Feature, a flag for each selector, Total, Rank), the ``n_features`` best of each target."""
        # The longest fits first.
        made = self.selections(*reversed(SELECTORS))
        return materialize(SEL.votes_by_target({t: {s: by[s] for s in SELECTORS} for t, by in made.items()}, self.sizes.n_features))

    @cached_property
    def best(self) -> dict[str, list[str]]:
        """The features of each target's model, by votes; names only reach the driver."""
        kept = best_features(self.votes.select("target", F.col("Feature").alias("feature"), F.col("Total").alias("score")),
                             self.sizes.n_features).collect()
        ranked = {t: sorted((r["rank"], r["feature"]) for r in kept if r["target"] == t) for t in self.targets}
        return {t: [f for _, f in rows] for t, rows in ranked.items()}

    def _of(self, target: str) -> DataFrame:
        """(visit, label, split, features): the matrix cut to the target's features."""
        at = {n: i for i, n in enumerate(self.names)}
        sliced = VectorSlicer(inputCol="features", outputCol="_kept", indices=[at[f] for f in self.best[target]]).transform(self.matrix)
        return sliced.select(KEY, F.col(target).alias("label"), F.col(f"{target}_split").alias("split"), F.col("_kept").alias("features"))

    @cached_property
    def trees(self) -> dict[str, object]:
        """The tuned tree of each target."""
        s = self.sizes
        out = {}
        for t in self.targets:
            train = materialize(self._of(t).where("split = 'train'"))
            most = [min(f, len(self.best[t])) for f in s.max_features]
            out[t] = ML.tree_cv(train, s.depths, sorted(set(most)), s.min_leaf, s.folds, s.seed)
        return out

    def _scored(self, split: str) -> DataFrame:
        frames = [ML.predict(self.trees[t], self._of(t).where(F.col("split") == split)).select(F.lit(t).alias("target"), "*")
                  for t in self.targets]
        return reduce(lambda a, b: a.unionByName(b), frames)

    @cached_property
    def predictions(self) -> DataFrame:
        """(target, visit, label, prediction, score) of the test rows."""
        return materialize(self._scored("test"))

    def report(self) -> DataFrame:
        """L11 for each target."""
        frames = [EV.classification_report(self.predictions.where(F.col("target") == t)).select(F.lit(t).alias("target"), "*")
                  for t in self.targets]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def calibrated(self) -> DataFrame:
        """Test scores beside their isotonic and sigmoid calibration, fitted on the validation rows."""
        valid = self._scored("validation")
        frames = [ML.calibrate(valid.where(F.col("target") == t), self.predictions.where(F.col("target") == t)) for t in self.targets]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def rules(self, labels: DataFrame) -> DataFrame:
        """The trees as rows with readable names; labels: (feature, readable)."""
        spark = self.matrix.sparkSession
        frames = [ML.tree_rules(spark, self.trees[t], self.best[t]).select(F.lit(t).alias("target"), "*") for t in self.targets]
        return ML.readable_rules(reduce(lambda a, b: a.unionByName(b), frames), F.broadcast(labels))

    def explained(self) -> DataFrame:
        """(target, visit, node, prediction, score): the test rows again, by walking the rules over the long features."""
        spark, out = self.matrix.sparkSession, []
        for t in self.targets:
            rows = self.predictions.where(F.col("target") == t)
            out.append(ML.apply_rules(rows, self.features, ML.tree_rules(spark, self.trees[t], self.best[t]), max(self.sizes.depths))
                       .select(F.lit(t).alias("target"), "*"))
        return reduce(lambda a, b: a.unionByName(b), out)
