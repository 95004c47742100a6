"""Chain analytics on Spark: a query builder over block, transaction, log and trace tables."""
