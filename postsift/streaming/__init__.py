"""Structured Streaming: validation per micro-batch and refresh requests."""

from postsift.streaming.jobs import start_refresh_requests, start_validation

__all__ = ["start_refresh_requests", "start_validation"]
