"""terrane: layered retail analytics (bronze, silver, gold) as Spark DataFrame operators."""

__version__ = "0.1.0"
