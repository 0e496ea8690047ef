"""Column functions: text helpers, similarity scores, phonetic codes."""
