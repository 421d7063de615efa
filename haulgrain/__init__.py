"""haulgrain: reusable DataFrame operators and data marts for freight analytics on Spark."""
