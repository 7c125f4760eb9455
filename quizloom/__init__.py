"""A PySpark-native engine for banks of assessment questions kept as semi-structured documents."""
