"""Road-checkpoint and click-stream analytics on PySpark."""
