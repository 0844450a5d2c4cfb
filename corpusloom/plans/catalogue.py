"""Every query of the library with its SQL oracle, by area."""

from __future__ import annotations

from corpusloom.plans.registry import ORACLES, QUERIES

from corpusloom.plans import chats, cleaning, dedup, evaluation, files, metadata, mixture, reports, sampling, series, stats, streams, tokens, web  # noqa: F401, E402  isort: skip

__all__ = ["ORACLES", "QUERIES"]
