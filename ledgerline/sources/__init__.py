"""ledgerline sources."""
