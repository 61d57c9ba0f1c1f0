"""Pure Python readers of wikitext; operators call them from vectorised functions."""
