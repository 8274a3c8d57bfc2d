"""stationflow: Spark-native station-utilization analytics.

Raw station and weather payloads are flattened into typed messages, joined on
event time, and reduced to hourly station / citywide utilization reports; the
history is compacted and a weather -> utilization regression is trained and
applied. Every step is an ordinary ``DataFrame -> DataFrame`` function, shared
by batch jobs and Structured Streaming.
"""

__version__ = "0.1.0"
