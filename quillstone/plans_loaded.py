"""All operator modules, loaded, and what they have registered."""

from quillstone.operators import forest, gold, history, matching, observability, peers, silver, versions  # noqa: F401
from quillstone.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
