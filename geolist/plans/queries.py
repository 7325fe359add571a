"""All registered queries of the library and their SQL."""

from . import flows, people, places, texts

MODULES = (places, texts, people, flows)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in MODULES for k, v in m.ORACLE.items()}
