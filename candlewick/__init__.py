"""candlewick: a Spark-native market-quote lakehouse.

Quote events are decoded into an append-only bronze table, typed and
deduplicated into silver (one row per instrument and quote time), and rolled
up into gold candles, a per-instrument snapshot and sector performance.
Quality checks gate every layer. Everything is a plain ``DataFrame -> DataFrame``
function over built-in Spark operators, usable in batch and streaming alike.
"""

__version__ = "0.1.0"
