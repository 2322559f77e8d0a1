"""End-to-end plans: the registered queries, their SQL oracles and the
composite jobs (split, evaluate, tune)."""
