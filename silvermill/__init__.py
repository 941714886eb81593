"""Bronze-to-silver table building on Spark: land, scan, flatten, keep latest, enrich, check, publish."""
