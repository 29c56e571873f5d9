"""panelforge: layered analytics over per-entity event logs on PySpark.

Bronze (raw, keyed upserts) -> silver (typed) -> gold (group averages, dense
ranks, rolling means, next-event targets), plus model training/scoring,
residual anomalies, data-quality checks, a run log and report datasets.
Column names are parameters, so the operators work on any table of that shape.
"""

__version__ = "0.1.0"
