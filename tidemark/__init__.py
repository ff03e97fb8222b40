"""tidemark: change-data-capture lakehouse jobs written with the Spark DataFrame API."""
