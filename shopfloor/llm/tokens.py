"""Token ids of public byte-level tokenizers, as packed little-endian numbers.

The ids are those of the ``tokenizers`` library. Its files of the byte-level kind list their
merges in the order of the ids they make, so the same ids come, several times faster, from a
rank encoder built on the file's own vocabulary; :func:`_ranks` checks that order. Texts go to
the ``tokenizers`` library itself wherever the two could differ: characters beyond the scripts
whose classes never change between versions of Unicode, very long runs of white space, and
literals of added tokens.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa

# How the byte-level kind splits a text before it merges: a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NOT_PLAIN = "[^\x00-ɏ]"
# A run of 400 white spaces covers four characters in a row of every hundredth.
_STRIDE, _BLANKS = 100, re.compile(r"\s{4}")
# Texts are handed to the tokenizer in lots of about so many characters.
LOT_CHARS = 500_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def lots(texts: pa.Array, limit: int = LOT_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``limit`` characters, with the place of the first; null: empty."""
    held: list[str] = []
    first, size = 0, 0
    for row, scalar in enumerate(texts):
        text = scalar.as_py() or ""
        if held and size + len(text) > limit:
            yield first, held
            held, first, size = [], row, 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


@cache
def byte_of_symbol() -> dict[str, int]:
    """The byte behind each symbol of a byte-level vocabulary.

    Printable characters of Latin-1 stand for their own byte, the other bytes in ascending order
    for the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@cache
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _added(path: str) -> dict[str, int]:
    return {x["content"]: x["id"] for x in _file(path)["added_tokens"]}


@cache
def token_bytes(path: str) -> list[bytes]:
    """Per id the bytes of its entry; added tokens stand for their own text."""
    symbols, special = byte_of_symbol(), _added(path)
    vocabulary = _file(path)["model"]["vocab"] | special
    entries = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for entry, number in vocabulary.items():
        plain = entry not in special and all(c in symbols for c in entry)
        entries[number] = bytes(map(symbols.get, entry)) if plain else entry.encode()
    return entries


def _ranks(path: str) -> dict[bytes, int] | None:
    """Rank per entry, if the file splits and merges as a rank encoder does; else None."""
    file = _file(path)
    split = file.get("pre_tokenizer") or {}
    model = file["model"]
    alike = (
        split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and file.get("normalizer") is None
        and not model.get("dropout")
        and not model.get("ignore_merges")
    )
    if not alike:
        return None
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"][a + b] for a, b in pairs]
    if any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    special = _added(path)
    known = token_bytes(path)
    return {known[n]: n for entry, n in model["vocab"].items() if entry not in special}


@cache
def _rank_encoder(path: str):
    ranks = _ranks(path)
    if ranks is None:
        return None
    import tiktoken

    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """The ids of texts by a tokenizer file, without special tokens around them.

    With ``added_tokens`` literals of added tokens become those tokens, as in the tokenizer's
    default state; otherwise they are split like any other text.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Added tokens that are not special stay whole in either state.
        self.literals = [x.content for x in added if added_tokens or not x.special]
        self.ranked = _rank_encoder(path)
        self.other = re.compile(_NOT_PLAIN)

    def _plain(self, text: str) -> bool:
        return (
            self.ranked is not None
            and (text.isascii() or not self.other.search(text))
            and not _BLANKS.search(text[::_STRIDE])
            and not any(x in text for x in self.literals)
        )

    def ids(self, texts: Sequence[str], code: str = "I") -> list[bytes]:
        """Per text its ids as little-endian numbers of 32 bits (``I``) or 16 (``H``)."""
        found: list[bytes | None] = [
            array(code, self.ranked.encode_ordinary(t)).tobytes() if self._plain(t) else None
            for t in texts
        ]
        rest = [k for k, done in enumerate(found) if done is None]
        whole = self.tokenizer.encode_batch_fast(
            [texts[k] for k in rest], add_special_tokens=False
        )
        for k, each in zip(rest, whole, strict=True):
            found[k] = array(code, each.ids).tobytes()
        return found
