"""Station analytics on Spark: gridded fields and monitoring sheets to modelling tables."""
