"""quarrystone: a Spark-first engine for preparing security-audit text corpora."""
