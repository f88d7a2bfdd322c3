"""Query plans: the registered queries and their oracle SQL."""


def all_queries():
    from cursorlake.plans import registry, lake_queries, loader_queries, stream_queries  # noqa: F401  (registration)
    return dict(registry.QUERIES)


def all_oracles():
    from cursorlake.plans.sql import ORACLE
    return dict(ORACLE)
