"""tessera — a Spark-native library of table analytics and machine-learning operators."""

__version__ = "0.1.0"
