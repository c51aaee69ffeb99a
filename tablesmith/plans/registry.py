"""All registered queries and their oracle SQL."""

from __future__ import annotations

from tablesmith.plans import q_clean, q_experiment, q_explore, q_flow

_MODULES = [q_experiment, q_clean, q_explore, q_flow]


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.Q)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
