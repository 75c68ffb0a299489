"""Structured Streaming: incremental landing into the store, live hourly KPIs."""
