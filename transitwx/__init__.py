"""Train timetables joined with weather observations, as Spark jobs."""

from transitwx.config import Settings

__all__ = ["Settings"]
