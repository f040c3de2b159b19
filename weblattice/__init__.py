"""weblattice: web-graph and text analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
