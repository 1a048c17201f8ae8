"""Flow analytics on Spark: Bronze, Silver and Gold layers, learning and evaluation."""
