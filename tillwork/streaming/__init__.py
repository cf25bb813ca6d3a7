"""Structured Streaming: live experiment counts and posteriors, daily ingestion."""
