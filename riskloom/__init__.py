"""riskloom: finding, scoring and studying risk signals in news text, on Spark."""

__version__ = "0.1.0"
