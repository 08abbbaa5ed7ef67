"""Spark-native analytics for labelled, high-dimensional measurement data."""

from .roles import Roles

__all__ = ["Roles"]
