"""Column functions: text in, text, words or a score out; no shuffle, no Python workers."""
