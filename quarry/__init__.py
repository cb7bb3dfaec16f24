"""quarry — Spark-native operators for database forensics, entity lifecycle jobs,
append logs and text-corpus retrieval.

Every operator takes DataFrames (plus plain parameters) and returns a DataFrame;
nothing is collected to the driver except bounded values: scalars (a count up to a
broadcast bound, the largest stored id, the row count of earlier log batches), one
query vector, and the entry nodes of a graph search (a fixed number).
"""

__version__ = "0.1.0"
