"""Registered queries with the SQL that states what each one returns."""

from . import dates, extraction, keyed, quality, relational, reports, stages, stored, text

MODULES = (reports, relational, text, dates, extraction, keyed, quality, stages, stored)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
