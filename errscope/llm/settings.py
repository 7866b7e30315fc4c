"""Production parameters of the queries and the pipeline: tokenizer files and mixing targets."""

from __future__ import annotations

import os


def tokenizer_path(name: str) -> str:
    """A file of the installed vocabulary package, or of the folder in ``TOKENIZER_DIR``."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def packing_tokenizer() -> str:
    return tokenizer_path("word_bpe_49k.json")


#: Wanted shares of tokens by value of ``labels.quality``.
MIX_WEIGHTS = {1: 0.9, 0: 0.1}
