"""Training-data operators: language ID, media copies, chat formatting, near and line deduplication,
decontamination, token output, quality scoring, page extraction and packing.

Nothing outside this folder imports it.
"""
