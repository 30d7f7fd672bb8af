"""Text-dataset curation on Spark: load, validate, clean, detect, sample, report."""

__version__ = "0.1.0"
