"""starlift: a Spark-native data-quality, warehouse, text-mining and
labour-analytics engine.

Every operator is a DataFrame-in / DataFrame-out function that takes column
names as parameters; nothing is collected to the driver except results whose
size is bounded by a parameter (vocabulary size, number of topics, number of
partitions).
"""

__version__ = "0.1.0"
