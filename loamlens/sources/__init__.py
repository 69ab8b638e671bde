"""Readers with declared schemas and the sinks of the batch job."""
