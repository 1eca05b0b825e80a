"""Feature screening, stacked risk models and scoring on Spark DataFrames.

A matrix is a *long* table ``(sample_id, feature, value)``, so that every
per-feature statistic is a distributed aggregation. Vectors are assembled only
for the final panel of features.
"""

__version__ = "0.1.0"
