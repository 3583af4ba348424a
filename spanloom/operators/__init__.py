"""DataFrame-to-DataFrame operators over token, span and decision tables."""
