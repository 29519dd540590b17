"""plumbline: data-quality and analysis operators for event data, written as Spark DataFrame programs."""

__version__ = "0.1.0"
