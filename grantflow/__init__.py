"""Grant-spending tables built with PySpark: readers, cleaning, joins, ordered
operators, table builders and incremental loading, all as DataFrame plans."""
