"""Shop-floor analytics as PySpark DataFrame operators.

Sub-packages
------------
functions   column expressions (rounding, spec flags, hashing, control constants)
sources     schemas, readers, writers, tables
operators   the analytical operators: silver, OEE, SPC, Pareto, labels, model, checks
plans       whole jobs composed from the operators, and the registered queries
streaming   Structured Streaming twins of the ingestion layer
"""

__version__ = "0.1.0"
