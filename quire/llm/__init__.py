"""Training-data operators: packing, mixing, quality, token counts, language ID, binary output, near-duplicates, LM scoring."""
