"""Training-data operators: deduplication, language, quality, mixing, packing, media, urls, pages."""
