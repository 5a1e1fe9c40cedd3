"""claimloom: a Spark-native engine for building claim-verification datasets."""

__version__ = "0.1.0"
