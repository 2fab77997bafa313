"""ranklift: Spark-native affinity scoring, ALS factors, reranking and replay evaluation.

Every operator is a function ``DataFrame -> DataFrame`` on the public PySpark
API; there is no global session and no import side effect.
"""

__version__ = "0.1.0"
