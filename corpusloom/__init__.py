"""corpusloom: encyclopedia-corpus analytics written as Spark DataFrame jobs."""
