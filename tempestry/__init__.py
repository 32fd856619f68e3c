"""Spark-native analytics over hazard-event records.

One row is one event: a place, a type, a year, a magnitude, harm counts and
damage amounts. Every operator takes a DataFrame and returns a DataFrame, so
Catalyst sees one declarative plan from the scan to the report.
"""

__version__ = "0.1.0"
