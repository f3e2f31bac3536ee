"""quarry: a PySpark-native text retrieval and ranking engine.

Documents, postings, vectors, queries and rankings are ordinary Spark
DataFrames; every operator is a DataFrame transformation so Catalyst and
AQE plan it for the cluster.
"""

from quarry.config import Params

__all__ = ["Params"]
