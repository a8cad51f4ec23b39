"""Column functions: vocabulary, text helpers, game derivations, move text."""
