"""Queries over the given tables, each with the SQL it must agree with."""

from docquay.queries import cleaning, collecting, jobs, keeping, reporting

QUERIES = {}
for _module in (collecting, cleaning, keeping, reporting, jobs):
    QUERIES.update(_module.QUERIES)
