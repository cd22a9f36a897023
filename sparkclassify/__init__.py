"""sparkclassify: supervised classification on Spark DataFrames.

Every step of the load -> clean -> featurise -> split -> fit -> score ->
evaluate lifecycle is a DataFrame operator that stays distributed from the
scan to the result.  Text features and naive Bayes exist in a "long form"
(one row per document and hash bucket) that is expressed entirely with
built-in Spark SQL functions, joins and aggregates, and in the vector form
of ``pyspark.ml``.  Tree and linear models use ``pyspark.ml`` directly.
"""

__version__ = "0.1.0"
