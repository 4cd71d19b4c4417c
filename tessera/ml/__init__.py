"""Fold machinery and learned stages (Spark ML)."""
