"""Mobile-signal analytics on Spark: pure DataFrame-to-DataFrame operators."""
