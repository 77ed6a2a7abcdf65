"""Registered queries; importing the modules fills the registry."""

from __future__ import annotations

from roadpulse.registry import tables, reports, graphs, files  # noqa: F401, I001  (views build on earlier ones)
from roadpulse.registry.base import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
