"""Analytics over cumulative counters of online videos, as Spark DataFrame jobs."""
