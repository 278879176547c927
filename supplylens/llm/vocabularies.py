"""Where the vocabulary files of public tokenizers lie."""

from __future__ import annotations

import os


def vocabulary(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file; ``folder`` is the place of the public_tokenizers package by default."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
