"""Readers and writers for the storage zones and Kafka."""
