"""Fixed-width feeds with several record types, transformed and reconciled on Spark."""

from .layouts import FEEDS
from .plans.job import Inputs, run_feed
from .plans.transform import extract, transform, typed, verdicts

__all__ = ["FEEDS", "Inputs", "extract", "run_feed", "transform", "typed",
           "verdicts"]
