"""Connected-device telemetry analytics on Spark."""

from velotrace.settings import Settings

__all__ = ["Settings"]
