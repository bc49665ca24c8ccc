"""Composite jobs (``jobs``), their command line (``cli``), and the driver
queries with their SQL oracles (``q_*``, collected in ``catalog``)."""
