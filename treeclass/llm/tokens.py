"""Public tokenizer files as encoders, loaded once per worker process."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import regex
import tiktoken

#: Folder of the public vocabulary files; a parameter of every operator that needs one.
FOLDER = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"

#: Fixed value: the public pre-token pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Fixed value: the token that the vocabulary adds to its merges, and its id.
ADDED = {"<|endoftext|>": 50256}

#: Runs of white space from this length on are cut into pre-tokens here: the rank-file encoder's own
#: pattern engine runs out of stack on very long ones.
BLANKS = 2000
_LONG = re.compile(r"\s{%d}" % BLANKS)
PRETOKEN = regex.compile(PATTERN)


def has_long_run(text: str) -> bool:
    """Whether a text holds a run of ``BLANKS`` white-space characters.  Such a run covers two
    neighbours of any sample of every ``BLANKS / 2``-th character, so few texts are searched."""
    sample = [c.isspace() for c in text[::BLANKS // 2]]
    return any(a and b for a, b in zip(sample, sample[1:])) and _LONG.search(text) is not None


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """Encoder of a rank file with the vocabulary's added token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def piece_ids(bpe: tiktoken.Encoding, piece: str) -> list[int]:
    """Ids of one pre-token of any length."""
    return bpe.encode_ordinary(piece) if len(piece) < BLANKS else bpe._encode_single_piece(piece)


def ordinary_ids(bpe: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text of any kind; the added token's string is ordinary text."""
    if not has_long_run(text):
        return bpe.encode_ordinary(text)
    return [i for piece in PRETOKEN.findall(text) for i in piece_ids(bpe, piece)]


def text_ids(bpe: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text as the JSON tokenizer gives them, the added token included."""
    if not has_long_run(text):
        return bpe.encode(text, allowed_special="all")
    (name, added), = ADDED.items()
    first, *rest = (ordinary_ids(bpe, part) for part in text.split(name))
    return first + [x for part in rest for x in [added, *part]]


def all_ids(bpe: tiktoken.Encoding, texts: list[str]) -> Iterator[list[int]]:
    """Ids of texts, of one at a time: a number in a list takes 36 bytes."""
    return (text_ids(bpe, text) for text in texts)


@lru_cache(maxsize=2)
def pieces(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def file(name: str, folder: str = FOLDER) -> str:
    return os.path.join(folder, name)
