"""Incremental HR and payroll feeds as PySpark DataFrame plans."""
