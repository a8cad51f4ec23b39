"""Spark-first analytics over board-game match archives and live event feeds."""

from rookery.session import tune

__all__ = ["tune"]
