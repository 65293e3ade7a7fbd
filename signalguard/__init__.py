"""Telemetry escalation on Spark: windows, forecast bands, roll-up, inference, dispatch.

Every operator takes a DataFrame and returns a DataFrame, and is generic over
column names.  The batch and the streaming jobs are built from the same parts.
"""
