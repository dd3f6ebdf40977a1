"""ledgerline streaming."""
