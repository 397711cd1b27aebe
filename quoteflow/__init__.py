"""Market-quote processing on Spark: portfolio symbols, quote documents, loads and price bars."""
