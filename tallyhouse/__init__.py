"""tallyhouse: activity-event analytics as Spark DataFrame functions.

Hourly newline-delimited JSON goes in; a deduplicated staging table, four daily
marts, report queries and data-quality checks come out.  Every function takes
and returns DataFrames, so Catalyst sees one declarative plan from scan to
result.
"""

__version__ = "0.1.0"
