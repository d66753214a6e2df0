"""Price-lag and shock analytics for paired series on Spark."""
