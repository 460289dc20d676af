"""Data-processing jobs on Spark: words, access logs, ad bids, flights, prices, weather, sensors."""
