"""strata: medallion-style retail analytics on Spark DataFrames.

Layers: text landing data (bronze) -> typed, cleaned, deduplicated tables
(silver) -> star schema (gold) -> business reports. Every operator is a
function from DataFrames to a DataFrame, expressed with built-in Spark
SQL functions so Catalyst can push filters, prune columns and pick join
strategies, and nothing is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
