"""DataFrame-to-DataFrame operators: cleaning, lookups, keys and constraints."""
