"""Plans: named queries over the driver tables, the gold refresh job and the SQL models."""
