"""Stream jobs on Structured Streaming, in event time with watermarks.

Every ``start_*`` function takes a streaming DataFrame and returns the running query. The source is up to the caller:
Kafka in production, files in tests.
"""
