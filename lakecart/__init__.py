"""lakecart — a retail event lakehouse on PySpark DataFrames.

Message-bus or file events → bronze / silver / quarantine with contracts, watermarks
and stateful dedupe → gold facts, revenue, leaderboard, inventory risk, data tests
and dashboard datasets.
"""

__version__ = "0.1.0"
