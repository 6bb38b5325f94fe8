"""Text operators for language-model corpora; nothing else in freshet imports this package."""
