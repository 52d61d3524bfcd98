"""Composed plans: the registered queries, their SQL oracles and the batch jobs."""
