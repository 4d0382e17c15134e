"""tarnlake: clinical lakehouse analytics as plain PySpark DataFrame operators."""
