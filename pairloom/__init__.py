"""Product-match warehouse built from Spark DataFrame operators."""
