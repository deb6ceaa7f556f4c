"""Column functions: cleaning, tokens, label predicates, hash order."""
