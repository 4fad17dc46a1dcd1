"""Operators for preparing training data: sharding, language labels,
near-duplicates, packing, quality, binary search, mixing, page text,
embedding joins, language-model scores, token files, cross-tokenizer
alignment and spelling variants. Nothing outside imports this."""
