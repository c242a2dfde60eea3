"""Structured Streaming: query control and the standing jobs."""

from wattspan.streaming.control import Run, await_all, checkpoint_for

__all__ = ["Run", "await_all", "checkpoint_for"]
