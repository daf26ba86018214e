"""kestrel: panel analytics (clean, integrate, feature, validate, explore, model) on Spark."""

__version__ = "0.1.0"
