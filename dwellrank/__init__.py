"""Area ranking analytics on Spark: scoring, spatial joins, punctuality and ranked marts."""
