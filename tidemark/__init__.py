"""Business-metric marts, reports and checks as Spark DataFrame plans."""

from tidemark.params import MartConfig, RunParams

__all__ = ["MartConfig", "RunParams"]
