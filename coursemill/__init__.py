"""A PySpark warehouse for online-education data: dimensions, facts, windows and reports."""
