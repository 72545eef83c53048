"""meterstar: usage analytics over a star schema of metered requests, on Spark."""
