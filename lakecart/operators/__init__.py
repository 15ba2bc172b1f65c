"""DataFrame operators.  Each is `DataFrame (+ config) → DataFrame`, built from Spark functions."""
