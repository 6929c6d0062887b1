"""Readers and writers: Kafka, files, JDBC, catalog tables."""
