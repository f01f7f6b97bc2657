"""Token ids of whole texts by a byte-level BPE read from ranks.

The ids are those that ``tokenizers`` gives for the same vocabulary: added tokens are taken
inside texts, the leftmost first. Runs of white space too long for the pattern matcher are
parted as its pattern parts them: all but the last character are one piece before a word,
the whole run at the end.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

ADDED_TOKENS = {"<|endoftext|>": 50256}  # of ``byte_bpe_50k.json``; the ranks lack it
LONG_RUN = 50_000  # white space that the matcher takes in one go
_ADDED = re.compile("(" + "|".join(map(re.escape, ADDED_TOKENS)) + ")")
# White space by Unicode; Python's own class takes four control characters more.
_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str):
    """Byte-level BPE from a file of ranks. It is built once in a worker."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _plain(encoding, text: str) -> list[int]:
    """Ids of a text without added tokens."""
    if len(text) < LONG_RUN:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in _SPACES.finditer(text):
        if run.end() - run.start() < LONG_RUN:
            continue
        ids.extend(encoding.encode_ordinary(text[at : run.start()]))
        at = run.end() if run.end() == len(text) else run.end() - 1
        ids.extend(encoding._encode_single_piece(text[run.start() : at]))
    ids.extend(encoding.encode_ordinary(text[at:]))
    return ids


def text_ids(encoding, text: str | None) -> list[int]:
    """Ids of a text; a null text has none."""
    if not text:
        return []
    ids: list[int] = []
    for part in _ADDED.split(text):
        if part in ADDED_TOKENS:
            ids.append(ADDED_TOKENS[part])
        elif part:
            ids.extend(_plain(encoding, part))
    return ids
