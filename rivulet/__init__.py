"""rivulet: change-data-capture and lakehouse pipelines as Spark DataFrame operators."""

__version__ = "0.1.0"
