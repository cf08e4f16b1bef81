"""tidemark: batch and stream analytics for event and order data on PySpark."""
