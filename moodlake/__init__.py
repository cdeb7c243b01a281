"""moodlake: a Spark-native track-analytics lakehouse.

Bronze -> silver -> SCD2 artist dimension -> gold star schema -> mood labels ->
feature table, quality reports and BI queries, every step a DataFrame function.
"""

__version__ = "0.1.0"
