"""ledgerlake: a PySpark engine over a daily, manifest-published chain archive."""

__version__ = "0.1.0"
