"""Tables read and written: texts, splits, tokenizers."""
