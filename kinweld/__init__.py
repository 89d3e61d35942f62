"""A Spark-native engine that fuses profile records of people."""
