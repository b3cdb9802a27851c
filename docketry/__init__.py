"""docketry: a PySpark-native analytics engine for large document catalogues."""

__version__ = "0.1.0"
