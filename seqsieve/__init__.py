"""A PySpark-native sequencing contaminant screen."""
