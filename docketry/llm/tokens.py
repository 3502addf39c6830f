"""Token ids of texts by a public byte-level BPE vocabulary.

The vocabulary file is a parameter and is opened where the ids are made. Tokenizing is split from
packing and writing so that both see the same ids.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public vocabulary's JSON file is."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")


@lru_cache(maxsize=4)
def encoder(path: str):
    """A function from a text to the ids that ``tokenizers`` gives it with the JSON file, without special tokens around it.

    The string of an added token inside a text is that token. The same vocabulary is on hand as merge
    ranks for a faster encoder; it is used where it is found beside the JSON file, for texts without
    such a string.
    """
    import os

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def exact(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    ranked = path.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranked):
        import public_tokenizers
        import tiktoken

        with open(ranked, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        made = tiktoken.Encoding(os.path.basename(ranked), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: exact(text) if any(a in text for a in added) else made.encode_ordinary(text)
    return exact


#: Code points a text is cut near before it is encoded, so that one very long text needs bounded memory.
_PIECE = 1 << 20
_CUT = re.compile(r"(?<=[A-Za-z0-9])[ \n](?=[A-Za-z0-9])")


def _pieces(text: str) -> list[str]:
    """``text`` in pieces whose ids, joined, are the ids of the whole.

    A piece ends before a blank or line feed that stands between two ASCII letters or digits: the
    vocabulary's pattern begins a new token there, and no added token holds such a place. A text that
    has none is one piece, whatever its length.
    """
    if len(text) <= _PIECE:
        return [text]
    out, start = [], 0
    while len(text) - start > _PIECE and (cut := _CUT.search(text, start + _PIECE)):
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def token_ids(text: str | None, path: str, end_id: int | None = 0) -> np.ndarray:
    """Ids of the text as unsigned 32-bit numbers, then ``end_id`` unless it is None; a null text is empty."""
    encode = encoder(path)
    parts = [np.array(encode(p), "<u4") for p in _pieces(text or "")]
    if end_id is not None:
        parts.append(np.array([end_id], "<u4"))
    return np.concatenate(parts)
