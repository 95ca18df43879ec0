"""tessera: data-mining operators expressed as Spark DataFrame plans.

Subpackages
-----------
sources    readers/parsers for the line formats and the test tables
functions  column expressions (hashing, vectors, features, math)
operators  DataFrame -> DataFrame jobs (LSH, linear models, clustering,
           bandits, selection, sampling, map-reduce)
plans      named queries over the test tables and their SQL oracles
streaming  Structured Streaming forms of the one-pass algorithms
"""

from tessera.session import get_spark, checkpoint_dir  # noqa: F401
