from .facts import admission_facts, column_profile, los_sample
from .priority import priority_combos
from .shares import share_difference, share_of_total, share_totals
from .stats import (
    average_billing, average_los, grand_totals, group_stats, merge_stats, overall_los,
    patient_days, total_billing, with_keys, with_parent,
)
from .variance import benchmark_variance, classified_variance

__all__ = [
    "admission_facts", "average_billing", "average_los", "benchmark_variance",
    "classified_variance", "column_profile", "grand_totals", "group_stats", "los_sample",
    "merge_stats", "overall_los", "patient_days", "priority_combos", "share_difference",
    "share_of_total", "share_totals", "total_billing", "with_keys", "with_parent",
]
