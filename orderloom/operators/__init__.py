"""DataFrame to DataFrame transformations."""
