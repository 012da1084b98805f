import random

import pytest
from pyspark.ml.regression import IsotonicRegression

from clinical_cohort.operators import calibration as CAL


def brute(points):
    """Largest over starts of the least over ends of the share of positives, by score."""
    d = {}
    for s, y in points:
        p, n = d.get(s, (0, 0))
        d[s] = (p + y, n + 1)
    keys = sorted(d)
    share = lambda a, b: sum(d[k][0] for k in keys[a:b + 1]) / sum(d[k][1] for k in keys[a:b + 1])
    return {k: max(min(share(a, b) for b in range(i, len(keys))) for a in range(i + 1)) for i, k in enumerate(keys)}


@pytest.mark.parametrize("n_buckets", [1, 3, 40])
def test_pools_match_max_min(spark, n_buckets):
    random.seed(n_buckets)
    points = [(random.randint(0, 60) / 60, 0) for _ in range(150)]
    points = [(s, int(random.random() < 0.2 + 0.6 * s * s)) for s, _ in points]
    df = spark.createDataFrame([*points, (None, 1), (0.5, None)], "score double, label int").repartition(4)
    fitted = CAL.isotonic_fit(df, n_buckets=n_buckets)
    pools = sorted(fitted.collect())
    assert all(a.hi < b.lo and a.value < b.value and (a.next_lo, a.next_value) == (b.lo, b.value) for a, b in zip(pools, pools[1:]))
    assert sum(r.n for r in pools) == 150
    got = {r.score: r.isotonic for r in CAL.isotonic_apply(df, fitted, n_buckets=n_buckets).collect()}
    want = brute(points)
    assert got.pop(None) is None and got == pytest.approx({**want, 0.5: got[0.5]})
    new = spark.createDataFrame([(x / 37 - 0.2,) for x in range(60)], "score double")
    model = IsotonicRegression(featuresCol="score", labelCol="label").fit(spark.createDataFrame(points, "score double, label int"))
    spark_says = {r.score: r.prediction for r in model.transform(new).collect()}
    ours = {r.score: r.isotonic for r in CAL.isotonic_apply(new, fitted, n_buckets=n_buckets).collect()}
    assert ours == pytest.approx(spark_says)


def test_extremes(spark):
    schema = "score double, label int"
    down = spark.createDataFrame([(i / 500, int(i < 250)) for i in range(500)], schema)
    assert [(r.lo, r.hi, r.pos, r.n) for r in CAL.isotonic_fit(down, n_buckets=64).collect()] == [(0.0, 0.998, 250, 500)]
    up = spark.createDataFrame([(i / 500, int(i >= 250)) for i in range(500)], schema)
    assert [(r.lo, r.hi, r.value) for r in sorted(CAL.isotonic_fit(up, n_buckets=64).collect())] == [(0.0, 0.498, 0.0), (0.5, 0.998, 1.0)]
    none = CAL.isotonic_fit(up.limit(0))
    assert none.collect() == []
    assert CAL.isotonic_apply(up.limit(3), none).select("isotonic").distinct().collect()[0][0] is None


def test_number_of_pools_is_bounded():
    """Shares of ever longer stretches: as many pools as there can be."""
    rows, n = [], 0
    fractions = sorted({(p / q, p, q) for q in range(1, 30) for p in range(q + 1) if all(p % d or q % d for d in range(2, q + 1))})
    for i, (_, p, q) in enumerate(fractions):
        rows.append((float(i), float(i), p, q))
        n += q
    assert len(CAL.pooled(rows)) == len(fractions) < 1.2 * n ** (2 / 3)
