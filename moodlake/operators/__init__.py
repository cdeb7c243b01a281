"""DataFrame -> DataFrame operators: silver, artists/SCD2, gold, quality,
mood classification, k-means, features and BI queries."""
