"""XML collections -> search records -> published index, as Spark jobs."""

__version__ = "0.1.0"
