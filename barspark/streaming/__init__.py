"""Structured Streaming: live bars, dedup, incremental indicators, alerts, fact upserts."""
