"""Queries over the given tables, each with its DuckDB counterpart where SQL can express it."""


def load():
    """The registry with every query module imported."""
    from checks import model_queries, registry, report_queries, scalar_queries  # noqa: F401

    return registry
