"""tidelog: a PySpark toolkit that turns database change events into lakehouse tables."""

from tidelog.schema import Feed

__all__ = ["Feed"]
