"""Column functions on reads: Spark SQL expressions, and array functions over whole batches where a read's characters are summed."""
