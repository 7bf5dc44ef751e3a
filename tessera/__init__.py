"""tessera: graph, set-similarity and text analytics as Spark DataFrame jobs."""

from tessera.operators.edges import (  # noqa: F401
    adjacency_text,
    avg_in_length,
    avg_out_length,
    graph_nodes,
    reverse_adjacency,
)
from tessera.operators.paths import (  # noqa: F401
    reachable_count,
    reachable_nodes,
    shortest_from_source,
    shortest_routes_to_target,
    shortest_to_target,
)
from tessera.operators.setsim import (  # noqa: F401
    order_tokens,
    prefix_index,
    set_similarity_join,
    similarity_candidates,
    token_frequency,
)
from tessera.operators.text import word_count_normalized, word_count_raw  # noqa: F401

__version__ = "0.1.0"
