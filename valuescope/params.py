"""Run parameters (one dataclass instead of four YAML files)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # dates / windows
    cutoff: dt.datetime = dt.datetime(2011, 6, 1)
    holdout_days: int = 180
    clv_horizon_days: int = 180
    # CLV models
    penalizer_bgnbd: float = 0.001
    penalizer_gg: float = 0.001
    discount_rate_annual: float = 0.10
    # else a fit that didn't converge, or a spend model without a population mean (q <= 1), fails the batch
    allow_unusable_fit: bool = False
    # churn
    inactivity_days: int = 90
    prediction_horizon_days: int = 180
    eval_gap_days: int = 60
    churn_model: str = "auto"
    seed: int = 42
    n_folds: int = 5
    # policy
    budget: float = 5000.0
    unit_cost: float = 2.0
    retention_effectiveness: float = 0.10
    min_clv: float = 0.0
    solver: str = "exact"  # exact (constant-cost knapsack) or greedy
    # evaluation
    n_deciles: int = 10
    n_bootstrap: int = 500
    ci_level: float = 0.95
    n_budget_points: int = 12
    # limits of the budget grids (None: none)
    max_curve_budget: float | None = None
    max_curve_customers: int | None = None
    max_sensitivity_budget: float | None = None
    # sensitivity
    n_scenarios: int = 1000
    effectiveness_range: tuple = (0.05, 0.25)
    cost_range: tuple = (1.0, 5.0)
    reference_budget: float = 2000.0
    variation: float = 0.5
    # cohorts
    max_months: int = 12
    min_cohort_size: int = 10
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


#: The original's limits of the budget grids.
ORIGINAL_BUDGET_LIMITS = {"max_curve_budget": 20000.0, "max_curve_customers": 10000, "max_sensitivity_budget": 8000.0}
# Parameters that suit the supplied TPC-H-like tables (order dates 1995-2001).
# Their amounts don't follow Gamma-Gamma (the fit converges at q <= 1); clv_params says so in its status columns.
TESTDATA_PARAMS = Params(cutoff=dt.datetime(2001, 1, 1), allow_unusable_fit=True, **ORIGINAL_BUDGET_LIMITS)
# Purchase-event fixture (January 2024, with time of day).
EVENTS_PARAMS = Params(cutoff=dt.datetime(2024, 1, 20), holdout_days=10, clv_horizon_days=10,
                       inactivity_days=5, prediction_horizon_days=10)
