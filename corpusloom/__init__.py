"""corpusloom: conversation, preference and agent-log preparation on Spark DataFrames.

Every operator takes DataFrames or Columns and returns DataFrames or Columns.
See README.md for the map from operator to module.
"""

__version__ = "0.1.0"
