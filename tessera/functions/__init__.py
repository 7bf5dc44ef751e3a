"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from tessera.functions.similarity import (  # noqa: F401
    check_threshold,
    jaccard,
    length_compatible,
    overlap_needed,
    position_compatible,
    prefix_length,
    size_band,
)
from tessera.functions.text import (  # noqa: F401
    WORD_DELIMITER_REGEX,
    WORD_DELIMITERS,
    delimited_pieces,
    split_on_space,
    text_lines,
    whitespace_words,
)
