"""Registered queries: each operator on the given tables, with equivalent SQL where SQL can say it."""

from custodia.catalog import exprs, files, governance, jobs, matching, metrics, observability, quality, versions

ENTRIES = {}
for _module in (metrics, quality, versions, matching, governance, observability, files, exprs, jobs):
    for _name, _entry in _module.ENTRIES.items():
        if _name in ENTRIES:
            raise ValueError(f"query {_name} registered twice")
        ENTRIES[_name] = _entry
