"""Outfall: Spark operators for routing logs and metrics to per-application syslog drains."""
