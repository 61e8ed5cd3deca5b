"""Where the files of the installed public tokenizers are."""

from __future__ import annotations

import os


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """The file's place: in ``folder``, else in that of ``TOKENIZER_DIR``, else in the
    installed ``public_tokenizers`` package."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
