"""Traffic, latency and error analytics over HTTP request logs, on Spark."""
