"""Table-to-model analytics on Spark: landed web pages to rows, features and models."""
