"""DataFrame -> DataFrame operators. Column names are parameters throughout."""
