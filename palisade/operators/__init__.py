"""Table-level operators: DataFrame in, DataFrame (or fitted pyspark.ml Model) out."""
