"""Ride-hailing analytics as PySpark DataFrame plans."""

from faremill.config import Settings
from faremill.plans.lake import Lake

__all__ = ["Lake", "Settings"]
