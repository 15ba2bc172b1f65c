"""Sinks K1–K6: layer layout, stream/overwrite/partition-replace writers, bus publish."""
