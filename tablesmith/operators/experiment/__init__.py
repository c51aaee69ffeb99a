"""Experiment analysis: event log -> sessions -> two-arm tests and checks."""

from tablesmith.operators.experiment.sessions import METRIC_FAMILY, session_metrics
from tablesmith.operators.experiment.stats import (arm_descriptives, arm_moments, bh_adjust,
                                                   cohens_d, levene_median, mann_whitney_u,
                                                   metric_report, normality_jb, power_table,
                                                   srm_chi2, tost, two_prop_z, welch_t,
                                                   arm_balance, decision_row)

__all__ = ["METRIC_FAMILY", "session_metrics", "arm_descriptives", "arm_moments", "bh_adjust",
           "cohens_d", "levene_median", "mann_whitney_u", "metric_report", "normality_jb",
           "power_table", "srm_chi2", "tost", "two_prop_z", "welch_t", "arm_balance",
           "decision_row"]
