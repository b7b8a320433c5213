"""Training-data operators: sharding, language, decontamination, duplicates, quality, tokens, mixing, chats.

Nothing else in the package imports this one. Rows are told apart by their id
and a hash of their text, so repeated ids are harmless; results that belong to
a row are joined back by that pair.
"""
