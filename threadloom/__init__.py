"""threadloom: dialogue and instruction corpora as Spark DataFrame transformations."""

__version__ = "0.1.0"
