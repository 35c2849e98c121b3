"""Queries over the event panel, whose users have at most 30 days, ask for few pairs."""

import numpy as np
import pytest

from checks import queries
from tests.conftest import series


@pytest.fixture
def short(spark, monkeypatch):
    """Ten days of one user, so that ten pairs are left at lag 0 and three at lag 7."""
    rng = np.random.default_rng(3)
    columns = ("w_steps", "weight_change", "trend_change_7d", "activity_proxy", "energy", "tdee_adaptive")
    rows = series(spark, {c: rng.normal(size=10).tolist() for c in columns})
    monkeypatch.setattr(queries, "wearable_report", lambda *_: rows)


def test_lag_matrix_needs_five_pairs(spark, short):
    rows = [r for r in queries.QUERIES["lag_matrix"](spark, "").collect() if any(v is not None for v in r[2:])]
    assert len(rows) == 1 and [v is not None for v in rows[0][2:]] == [k <= 5 for k in range(8)]


def test_lag_two_targets_needs_eight_pairs(spark, short):
    known = queries.QUERIES["lag_two_targets"](spark, "").where("r is not null").collect()
    assert sorted((r["target"], r["lag"]) for r in known) == [(t, k) for t in ("change", "trend") for k in range(3)]


def test_bias_signal_needs_five_pairs(spark, short):
    row = queries.QUERIES["bias_signal"](spark, "").first()
    assert row["n"] == 10 and row["r"] is not None
