"""Training-data operators: deduplication, tokens, quality, mixing, search and chat text.

Every operator takes and returns DataFrames. ``seatrace.llm.registry`` holds the queries
built on them.
"""
