"""legajo: a PySpark-native engine for ingesting, cleaning and querying legal documents."""

__version__ = "0.1.0"
