"""Operators of a training-data pipeline: near duplicates, token counts, repeated
passages, personal data, benchmark leaks, packing, page text, chat masks, licence
notices and quality rules. Nothing else in the package imports this one."""
