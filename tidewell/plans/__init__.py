"""Every operator as a query over the tables of a data folder, with its SQL twin."""

from tidewell.plans import batch, changes, detection, loading, search, streams

MODULES = (batch, search, detection, loading, changes, streams)


def all_queries():
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def all_oracles():
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
