"""Training-data operators: sharding, chat formatting, mixing, URL lists, quality, packing, dedup, toxicity."""
