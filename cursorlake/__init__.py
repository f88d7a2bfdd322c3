"""cursorlake: a Spark-native pipeline for browser interaction events.

Payloads (mouse and keyboard) are routed to topics, decoded leniently or with
typed defaults, stamped with event time and hour partitions, written once-only
into partitioned Parquet tables by Structured Streaming, hit-tested against
canvas shapes, and read back as listings, counts and per-minute histograms.
"""
