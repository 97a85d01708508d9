"""tidemark: market-data dataset builders as Spark DataFrame plans."""

__version__ = "0.1.0"
