"""Queries that can be checked against SQL on the supplied tables."""


def load():
    """All registered queries and the SQL twins of those that have one."""
    from topicweave.catalog import base, cleaning, evaluation, modelling, supervised  # noqa: F401

    return base.QUERIES, base.ORACLES
