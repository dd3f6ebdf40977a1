"""ledgerline plans."""
