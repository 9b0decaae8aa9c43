"""statloom: statistical feature analysis for large tables, written for Spark."""
