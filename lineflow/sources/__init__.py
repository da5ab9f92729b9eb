"""Connections: configuration, HTTP and TCP transports, the Spark data source."""
