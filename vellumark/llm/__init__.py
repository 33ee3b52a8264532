"""Operators of a training-data pipeline. Executors need this package on their Python path (--py-files or installed)."""
