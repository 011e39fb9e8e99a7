"""Evidence linking genome positions to genes, assembled and scored on Spark."""

__version__ = "0.1.0"
