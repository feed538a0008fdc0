"""Retail analytics operators on Spark DataFrames."""

from .params import Params

__all__ = ["Params"]
