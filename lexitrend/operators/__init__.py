"""DataFrame -> DataFrame steps."""

from . import bank, broadcast, explore, fact, frequency, sentiment, trends

__all__ = ["bank", "broadcast", "explore", "fact", "frequency", "sentiment", "trends"]
