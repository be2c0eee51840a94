"""Usage-log analytics for a cloud data warehouse, written as Spark DataFrame jobs."""

from usagelens.session import Settings, build_session, use_utc

__all__ = ["Settings", "build_session", "use_utc"]
