"""Job plans: the registered fixture queries, their SQL oracles and the
per-date pipeline runner."""
