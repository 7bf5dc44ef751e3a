"""Query catalog: registered jobs over the test tables and their SQL oracles."""

from tessera.plans.catalog import ORACLE_SQL, QUERIES  # noqa: F401
