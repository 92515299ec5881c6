"""Readers and writers: partitioned Parquet, COPY text, exports, change streams."""
