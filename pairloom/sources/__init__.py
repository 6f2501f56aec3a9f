"""Where records come from and where the collection is kept."""
