"""DataFrame operators of the layered flows (bronze, silver, gold, quality)."""
