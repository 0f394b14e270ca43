"""Impact-measurement analytics as Spark DataFrame operations.

Tables travel as ``dict[str, DataFrame]`` keyed by table name (see
:mod:`tallygrove.model`).  Functions return DataFrames and leave the
plan to Catalyst; those that write intermediate tables or measure a dimension
before they broadcast it run jobs of their own and say so.
"""

__version__ = "0.1.0"
