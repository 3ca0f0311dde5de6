"""tickermill: market-data lake, fundamental scoring and reports as Spark DataFrame transforms."""
