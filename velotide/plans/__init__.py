"""Jobs: operators chained from source to sink."""
