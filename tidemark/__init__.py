"""Change-data-capture analytics as DataFrame-to-DataFrame operators on Spark."""
