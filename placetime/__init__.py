"""placetime: incident analytics on Spark DataFrames.

Tables whose rows carry a category, a place (latitude, longitude) and an
hour are cleaned, enriched, filtered, counted, pivoted, correlated,
clustered, classified and scored, all as distributed Spark jobs.
"""

from .roles import ColumnRoles, FilterSpec

__all__ = ["ColumnRoles", "FilterSpec"]
