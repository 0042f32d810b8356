"""Token ids of public BPE files, equal to what the tokenizers library gives.

The vocabulary and the merge order come from the JSON file of that library;
tiktoken merges the pieces.  Texts outside the form that these classes handle
exactly go to the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# The split patterns of the two public tokenizer files.
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                r"|\s+(?!\S)|\s+")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def alphabet() -> dict[str, int]:
    """Printable stand-in -> byte, as byte-level BPE files write bytes."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b if b in plain else next(others)): b for b in range(256)}


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class ByteBpe:
    """Byte-level BPE: text -> uint32 ids, and the bytes of each id."""

    def __init__(self, path: str):
        spec = load(path)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        chars = alphabet()
        self.ranks = {bytes(chars[c] for c in token): i
                      for token, i in spec["model"]["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.allowed = set(self.specials)
        self.core = tiktoken.Encoding("byte-bpe", pat_str=BYTE_PATTERN,
                                      mergeable_ranks=self.ranks, special_tokens=self.specials)
        self.bytes_of: dict[int, bytes] = {i: b for b, i in self.ranks.items()}
        self.bytes_of.update({i: s.encode() for s, i in self.specials.items()})

    def ids(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, allowed_special=self.allowed)


# Characters of the fast path of WordBpe, all within one byte of Latin-1.
_LETTERS = [*range(0x61, 0x7B), *(c for c in range(0xDF, 0xFF) if c != 0xF7)]
_PUNCT = [c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'^`~\\"]
_ENDS = [c for c in (*range(0x01, 0x09), *range(0x0E, 0x20), 0x7F)]
_SPACE = b" \t\n\r"


class WordBpe:
    """Lower-casing BPE with word ends ('</w>'): text -> uint32 ids.

    In Latin-1 text the last character of every piece is exchanged for a spare
    one that stands for "this character at a word end" (capitals for letters,
    control characters for punctuation), so one byte-level merge table serves
    both forms of each symbol.  Chunks between white space with any other
    character are encoded by the tokenizers library; white space always ends
    a piece, so the parts are independent.
    """

    def __init__(self, path: str):
        spec = load(path)
        if spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path} has no word ends")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[str, np.ndarray] = {}

        end = {c: c - 0x20 for c in _LETTERS if c != 0xDF} | {0xDF: 0xD7}
        end |= dict(zip(_PUNCT, _ENDS)) | {c: c for c in range(0x30, 0x3A)}
        lower = {c: c for c in (*_LETTERS, *_PUNCT, *range(0x30, 0x3A))}
        lower |= {c: c + 0x20 for c in (*range(0x41, 0x5B), *range(0xC0, 0xDF)) if c != 0xD7}
        self.low = np.zeros(256, np.uint8)
        self.end = np.zeros(256, np.uint8)
        self.kind = np.zeros(257, np.uint8)  # 1 letter, 2 punctuation, 3 digit, 0 white space
        for c, l in lower.items():
            self.low[c], self.end[c] = l, end[l]
            self.kind[c] = 3 if chr(c).isdigit() else 2 if c in _PUNCT else 1
        for c in _SPACE:
            self.low[c] = self.end[c] = 0x20
        self.odd = np.ones(256, bool)  # bytes that the fast path does not know
        self.odd[[*lower, *_SPACE]] = False
        safe = "".join(re.escape(chr(c)) for c in (*lower, *_SPACE))
        white = re.escape(_SPACE.decode())
        special = "|".join(re.escape(t["content"]) for t in spec["added_tokens"])
        self.special = re.compile(special)
        self.odd_chunk = re.compile(f"[^{white}]*(?:[^{safe}]|{special})[^{white}]*")

        # Byte form of every symbol: plain as it is, at a word end as the stand-in's UTF-8.
        plain, last = {}, {}
        for c in (*_LETTERS, *_PUNCT):
            mid, fin = chr(c).encode(), chr(end[c]).encode()
            for b in mid[:-1]:
                plain[b] = b
            plain[mid[-1]], last[mid[-1]] = mid[-1], fin[-1]
        last |= {c: c for c in range(0x30, 0x3A)}
        chars, self.ranks = alphabet(), {}
        for token, i in spec["model"]["vocab"].items():
            word = token.endswith("</w>")
            raw = [chars[c] for c in (token[:-4] if word else token)]
            if not all(b in plain for b in (raw[:-1] if word else raw)) \
                    or word and (not raw or raw[-1] not in last):
                continue
            self.ranks[bytes([plain[b] for b in (raw[:-1] if word else raw)]
                             + ([last[raw[-1]]] if word else []))] = i
        marks = "".join(re.escape(chr(c)) for c in _PUNCT), "".join(f"\\x{c:02x}" for c in _ENDS)
        self.core = tiktoken.Encoding(
            "word-bpe", pat_str=rf"\p{{Ll}}*[\p{{Lu}}×]|[0-9]|[{marks[0]}]*[{marks[1]}]",
            mergeable_ranks=self.ranks, special_tokens={})

    def _known(self, text: str) -> np.ndarray | None:
        """Ids of a text of known characters only, else None."""
        try:
            raw = np.frombuffer(text.encode("latin-1"), np.uint8)
        except UnicodeEncodeError:
            return None
        if self.odd[raw].any() or self.special.search(text):
            return None
        kind = self.kind[raw]
        after = np.append(kind[1:], 0)
        stop = (kind != after) | (kind == 3)
        marked = np.where(stop, self.end[raw], self.low[raw])
        return self.core.encode_to_numpy(marked.tobytes().decode("latin-1"),
                                         disallowed_special=())

    def _exact(self, chunk: str) -> np.ndarray:
        ids = self.memo.get(chunk)
        if ids is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            ids = np.array(self.library.encode(chunk, add_special_tokens=False).ids, np.uint32)
            if len(chunk) < 100:
                self.memo[chunk] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        ids = self._known(text)
        if ids is not None:
            return ids
        parts, at = [], 0
        for m in self.odd_chunk.finditer(text):
            parts += [self._known(text[at:m.start()]), self._exact(m.group())]
            at = m.end()
        return np.concatenate([*parts, self._known(text[at:])])


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
