"""Feed audit and silver-table building blocks for PySpark.

Every operator is a plain function from DataFrames to a DataFrame; thresholds, domains, keys and
gate codes travel in a :class:`~feedgate.contract.FeedContract`.
"""

from feedgate.contract import FeedContract

__all__ = ["FeedContract"]
