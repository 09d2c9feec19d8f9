"""Device telemetry on Spark: parse, route, latest value, archive, audit and export."""
