"""Credit-risk analytics on firm-month panels, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
