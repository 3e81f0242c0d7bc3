"""DataFrame -> DataFrame operators of the bronze/silver/gold layers."""
