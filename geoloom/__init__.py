"""geoloom: extracts from dumps of a versioned geographic database, on PySpark."""
