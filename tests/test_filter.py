"""The smoothed choice of the independent filter's cut-off."""

import numpy as np
import pytest

from taxaloom.operators import testing as X


def test_lines_are_kept_and_outliers_hardly_count():
    x = np.linspace(0, 1, 50)
    assert X.lowess(x, 3 * x + 1) == pytest.approx((3 * x + 1).tolist())
    y = 3 * x + 1 + 0.1 * np.sin(37 * x)
    y[20] += 1
    fit = np.array(X.lowess(x, y))
    assert np.abs(fit - (3 * x + 1)).max() < 0.25
    assert X.lowess([0.0, 0.0, 0.0], [1.0, 2.0, 3.0]) == pytest.approx([2.0, 2.0, 2.0], abs=0.5)


def test_smoothed_rule_takes_an_early_cut():
    shares = np.linspace(0, 0.95, 50).tolist()
    # A plateau whose maximum comes late by one: the smoothed rule stops at its start.
    rejections = [100 + min(i, 20) * 5 for i in range(50)]
    rejections[45] += 1
    assert X.chosen_cut(rejections, shares, "most") == 45
    assert X.chosen_cut(rejections, shares, "smoothed") <= 21
    assert X.chosen_cut([0] * 20 + [10] * 30, shares, "smoothed") == 0
    assert X.chosen_cut([0] * 50, shares, "most") == 0


def test_filter_of_nothing_and_of_nulls(spark):
    schema = "feature string, pvalue double, base_mean double"
    assert X.independent_filter(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([("a", None, 5.0), ("b", 0.01, 5.0), ("c", 0.5, 0.0)], schema)
    made = {r.feature: r.padj for r in X.independent_filter(df, rule="smoothed").collect()}
    assert made["a"] is None and made["b"] is not None
