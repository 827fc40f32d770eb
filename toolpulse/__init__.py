"""toolpulse: predictive-maintenance analytics for machine-sensor tables, on PySpark."""

__version__ = "0.1.0"
