"""Silver, gold, quality, feature and model operators."""
