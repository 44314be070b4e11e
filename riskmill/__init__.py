"""Bank-transaction risk pipeline on Spark: Bronze, Silver, Gold, training and scoring."""

__version__ = "0.1.0"
