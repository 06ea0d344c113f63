"""Medallion analytics on Spark: raw JSON -> bronze -> silver -> gold -> reports.

Every transformation is a DataFrame -> DataFrame function that neither opens a
session nor runs a job. Only the functions that write (``land_records``,
``write_*``, ``publish``, ``export_tables``, the streaming jobs) run anything.
"""

from refinery.roles import Roles

__all__ = ["Roles"]
