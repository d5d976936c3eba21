"""brookweave: a config-driven data-propagation and analytics library on Spark DataFrames."""

__version__ = "0.1.0"
