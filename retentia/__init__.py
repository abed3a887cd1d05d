"""Subscription-revenue and customer-health analytics as PySpark DataFrame functions."""

from retentia.params import Params, ScorePoints
from retentia.session import configure

__all__ = ["Params", "ScorePoints", "configure"]
