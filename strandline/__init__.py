"""strandline: shoreline time series and corpus preparation as Spark DataFrame jobs."""
