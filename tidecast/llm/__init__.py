"""Training-data operators: language ID, packing, licence scans, HTML
extraction, deduplication, token counts, toxicity, quality rules, n-gram
joins and tokenization. Nothing outside this subpackage imports it."""
