"""Every query of the load-survey engine by name, with its oracle."""

from voltweave.plans.oracles import ORACLES
from voltweave.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
