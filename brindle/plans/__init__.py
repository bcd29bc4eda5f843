"""Registered queries; importing load() fills the registry."""

from __future__ import annotations

from importlib import import_module

MODULES = ["problems", "ranking", "history", "functions", "entities", "checks", "serving", "catalog", "reports"]


def load() -> None:
    for name in MODULES:
        import_module(f"brindle.plans.{name}")
