"""Geo-temporal event-risk analytics expressed as Spark DataFrame jobs."""

from georisk.roles import Roles

__all__ = ["Roles"]
