"""Transaction analytics as composable Spark DataFrame operators."""

from ledgerflow.settings import Settings

__all__ = ["Settings"]
