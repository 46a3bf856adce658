"""tagweave: user-tag (profile) analytics on Spark DataFrames.

Tag computation from SQL with value rules, per-day partitioned tag tables,
the wide per-user tag table, uid bitmaps per tag value, serving exports and
decision-tree tag prediction -- all as DataFrame / SQL / Spark ML plans.
"""

__version__ = "0.1.0"
