"""Registered queries, their SQL, and the telemetry view they read."""
