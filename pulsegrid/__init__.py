"""pulsegrid: Spark-native feature engineering and ordinal modelling for
participant tables joined with long wrist-sensor series."""

__version__ = "0.1.0"
