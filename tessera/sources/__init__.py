"""Sources and sinks: reference text formats and the parquet test tables."""

from tessera.sources.files import EDGE_SCHEMA, read_edges, read_lines, read_sets  # noqa: F401
from tessera.sources.sinks import write_kv, write_pairs, write_tuples  # noqa: F401
from tessera.sources.tables import (  # noqa: F401
    edges_path,
    edges_supply,
    lines_docs,
    load_table,
    sets_docs,
    sets_orders,
)
