from .text import (  # noqa: F401
    clean_message,
    split_tokens,
    content_hash,
    tokenize_message,
    detokenize_pattern,
    dedup_adjacent_tokens,
    lower_tokens,
    keep_alpha_tokens,
    remove_stop_tokens,
    collapse_placeholders,
    cluster_uuid,
)
from .similarity import token_similarity, char_similarity, prefix_similarity  # noqa: F401
