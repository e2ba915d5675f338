"""Sales analytics and customer segmentation over a Parquet lake, on Spark."""
