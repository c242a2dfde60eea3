"""Analytics for electricity-network telemetry on Spark."""

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.session import build_session

__all__ = ["DEFAULT_CONFIG", "EngineConfig", "build_session"]
