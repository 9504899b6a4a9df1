"""Zone-based analytics on Spark: landing, trusted, exploitation and consumption."""

__version__ = "0.1.0"
