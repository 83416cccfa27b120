"""Dispatch and event analytics as DataFrame-to-DataFrame functions on Spark.

Timestamps are read as UTC: run with ``spark.sql.session.timeZone=UTC``.
"""
