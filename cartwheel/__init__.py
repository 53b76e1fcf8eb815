"""Commerce analytics on Spark: cleaning, business queries, warehouse, clickstream.

Every operator is a DataFrame -> DataFrame function built from Catalyst
expressions; see README.md for the map from operators to modules.
"""

__version__ = "0.1.0"
