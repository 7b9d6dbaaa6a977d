"""Thresholds and defaults used across the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    # Defaults of the analyses being rebuilt (kept as published).
    seed: int = 42
    sample_size: int = 5000
    pair_columns: int = 8
    contamination: float = 0.05
    confidence: float = 0.95
    rare_count: int = 5
    frequent_count: int = 100
    high_cardinality: int = 50
    corr_high: float = 0.95
    corr_moderate: float = 0.7
    vif_high: float = 10.0
    vif_moderate: float = 5.0
    psi_bins: int = 10
    drift_threshold: float = 0.2
    leak_corr: float = 0.99
    nzv_top_freq: float = 0.95
    nzv_unique_ratio: float = 0.01
    bootstrap_rounds: int = 30
    woe_bins: int = 10
    monotone_bins: int = 10
    subgroup_min: int = 30
    categories_shown: int = 30
    cat_threshold: int = 12
    problem_type_levels: int = 20
    rare_share: float = 0.01
    quasi_constant: float = 0.97
    interaction_k: int = 8
    histogram_bins: int = 40
    # Percentile strategy: "exact" keeps a value->count map per group (Spark's
    # `percentile`); "approx" uses the bounded-memory GK sketch
    # (`percentile_approx`) and is the right choice for continuous columns
    # with billions of distinct values.
    quantile_mode: str = "exact"
    quantile_accuracy: int = 100000
    # Largest dimension table (rows) that may be broadcast without a check
    # of its actual size; see plans.frames.small_enough_to_broadcast.
    broadcast_row_limit: int = 1_000_000
    percentiles: tuple = field(default=(0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99))


DEFAULT = Config()
