"""Column-returning expressions: text cleaning, numeric features, dates and
row-wise statistics."""

from tessera.functions import dates, numeric, rows, text  # noqa: F401
