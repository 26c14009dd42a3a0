"""Composite plans: the popularity report and the two-round k-center."""

from robustagg.plans.popularity_report import popularity_report
from robustagg.plans.two_round import exact_summary, two_round_kcenter, two_round_summary

__all__ = ["popularity_report", "exact_summary", "two_round_kcenter", "two_round_summary"]
