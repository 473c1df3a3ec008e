"""DataFrame -> DataFrame building blocks; column names are parameters throughout."""
