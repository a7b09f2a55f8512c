"""dialtone: contact-centre reports as Spark DataFrame plans.

Each report is a plain function from DataFrames and parameters to a
DataFrame. Nothing runs until an action is called on the result, so
Catalyst sees the whole plan: filters reach the parquet scan, unused
columns are pruned and one conditional aggregate replaces the
per-measure join chains of a row-store formulation.
"""

__version__ = "0.1.0"
