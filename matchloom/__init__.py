"""Match and team statistics as lazy DataFrame-to-DataFrame operators on Spark."""

__version__ = "0.1.0"
