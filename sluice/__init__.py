"""Config-driven event processing on Spark: decode, check, dedup, transform, validate, route."""

from sluice.session import prepare, local_session

__all__ = ["prepare", "local_session"]
