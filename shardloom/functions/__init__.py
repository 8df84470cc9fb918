"""Column expressions: text cleaning, prompt rendering, token arrays, tokenizers."""
