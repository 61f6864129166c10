"""Ids of a public byte-level BPE vocabulary.

The vocabulary file is the one of the `tokenizers` library. Encoding runs through
`tiktoken` with ranks taken from that file, which gives the same ids several times
faster. The two libraries may follow different versions of Unicode, so words with
characters outside the long settled Latin blocks go through `tokenizers` itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# Fixed value: the byte-level pattern that splits a text before the merges, but for the `\s+(?!\S)` before
# its last alternative: without a look-ahead it runs faster, and texts are cut where that one decides (`SPLIT`).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
# The characters of Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Merges never cross a change between white space and another character.
WORDS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
# Of much white space before another character the last one belongs to what follows.
SPLIT = re.compile(f"[{WHITE}]{{2,}}(?=[^{WHITE}])")
# Characters below have had the same class in every version of the libraries in use.
UNSETTLED = re.compile("[^\x00-\u024f]")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte.

    Printable Latin-1 characters stand for themselves, the other bytes get the
    letters from 256 on, in order.
    """
    shown = [b for b in range(256) if chr(b).isprintable() and b != 32]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Ids of texts.

    Per id: whether it starts with a space or a line end, ends with a stop or white space.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in model["model"]["vocab"].items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        size = max(ranks.values()) + len(special) + 1
        self.spaced, self.lined, self.stops, self.blank = np.zeros((4, size), bool)
        for token, rank in ranks.items():
            self.spaced[rank] = token[:1] == b" "
            self.lined[rank] = token[:1] == b"\n"
            self.stops[rank] = token[-1:] in (b".", b"!", b"?")
            self.blank[rank] = token[-1:].isspace()

    def encode(self, text: str) -> np.ndarray:
        """All ids of a text; strings of special tokens are ordinary text."""
        if not UNSETTLED.search(text):
            cuts = [match.end() - 1 for match in SPLIT.finditer(text)]
            if not cuts:
                return self.fast.encode_to_numpy(text)
            bounds = zip([0, *cuts], [*cuts, len(text)])
            return np.concatenate([self.fast.encode_to_numpy(text[a:b]) for a, b in bounds])
        parts = [
            self.exact.encode(word, add_special_tokens=False).ids
            if UNSETTLED.search(word)
            else self.fast.encode_ordinary(word)
            for word in WORDS.findall(text)
        ]
        return np.fromiter((i for part in parts for i in part), np.uint32)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """This worker's encoder."""
    return ByteEncoder(path)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary on this machine; every executor resolves its own."""
    import public_tokenizers

    return public_tokenizers.path(name)
