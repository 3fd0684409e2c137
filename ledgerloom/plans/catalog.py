"""All registered queries."""

from ledgerloom.plans import books, explore, flow  # noqa: F401
from ledgerloom.plans.registry import QUERIES, stand_alone

__all__ = ["QUERIES", "stand_alone"]
