"""stockrisk: stockout-risk analytics over daily inventory snapshots, on Spark."""

__version__ = "0.1.0"
