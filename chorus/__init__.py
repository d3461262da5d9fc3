"""Topic analytics over large collections of short user texts, on Spark."""
