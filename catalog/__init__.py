"""The registered queries over the given tables, each with the SQL that checks it where SQL can."""

from catalog import formats, graph, pages, text

ENTRIES = {**text.ENTRIES, **graph.ENTRIES, **pages.ENTRIES, **formats.ENTRIES}
QUERIES = {name: query for name, (query, _) in ENTRIES.items()}
ORACLES = {name: sql for name, (_, sql) in ENTRIES.items() if sql}
