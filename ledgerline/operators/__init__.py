"""ledgerline operators."""
