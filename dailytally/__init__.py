"""dailytally: daily order metrics kept current incrementally, on Spark.

Main entry points: ``dailytally.plans.jobs.MetricsJob`` (batch runs),
``dailytally.streaming.changefeed.ChangeFeedJob`` (Structured Streaming),
and the DataFrame operators under ``dailytally.operators``.
"""

__version__ = "0.1.0"
