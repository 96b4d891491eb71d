"""driftlens: schema-drift detection on Spark.

Watches the column metadata of registered tables, captures a baseline,
compares it with live metadata under a data-driven rule catalogue and
publishes anomaly rows and daily reports, all as set-based DataFrame plans.
"""

__version__ = "0.1.0"
