import random
import warnings

import numpy as np
import pytest

from newsloom.llm import mixing as M


@pytest.fixture(scope="module")
def skewed(spark):
    """One domain with a hundredth of the tokens, and what is known of each document."""
    rng, rows = random.Random(2), []
    for i in range(2000):
        k = 2 if i % 100 == 0 else int(i % 5 > 2)
        p = [0.0005, 0.0005, 0.0005]
        p[k] = 0.999
        rows.append((i, rng.randint(20, 80), p))
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")


def test_a_small_domain_reaches_its_target(skewed):
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        mix = M.fit_rates(skewed, M.Classifier(["aa", "bb", "cc"], [0.0] * 3), {"aa": 0.4, "bb": 0.4, "cc": 0.2})
    assert max(r.rate for r in M.with_rates(skewed, mix).collect()) > 16
    assert not mix.missed() and np.allclose(list(mix.totals.values()), list(mix.targets.values()), rtol=1e-3)


def test_a_missed_target_is_told(skewed):
    with pytest.warns(UserWarning, match="missed"):
        mix = M.fit_rates(skewed, M.Classifier(["aa", "bb", "cc"], [0.0] * 3), {"aa": 0.4, "bb": 0.4, "cc": 0.2}, most=16.0)
    assert mix.missed()["cc"] < 0


def test_targets_in_reach_are_met_where_many_documents_stay_at_the_bound(spark):
    rng, rows = np.random.default_rng(5), []
    for i in range(3000):
        p = rng.dirichlet([0.6, 0.2, 0.1])
        rows.append((i, int(rng.integers(20, 80)), p.tolist()))
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        mix = M.fit_rates(df, M.Classifier(["aa", "bb", "cc"], [0.0] * 3), {"aa": 0.12, "bb": 0.28, "cc": 0.6})
    assert not mix.missed()
    assert sum(r.rate == 0 for r in M.with_rates(df, mix).collect()) > 300
