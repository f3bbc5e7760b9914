"""slicecheck: check on Spark that two copies of wide KPI tables agree."""
