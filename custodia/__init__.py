"""custodia: governed batch analytics on PySpark.

Every operator takes and returns DataFrames; tables, keys, rules, the clock
(``as_of``), the run id and the actor are arguments.
"""

__version__ = "0.1.0"
