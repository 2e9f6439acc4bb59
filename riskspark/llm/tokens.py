"""Token ids of public vocabularies, equal to what the ``tokenizers`` library returns.

Two shapes of vocabulary have a fast path: byte-level BPE, and lower-cased word BPE with an
end-of-word mark. Both run the file's own merges through ``tiktoken``; every other file, and
every text outside the stated limits of a fast path, goes to ``tokenizers`` itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# The split patterns that the two kinds of vocabulary file are defined with.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

LONG_RUN = 5_000          # longer runs of one kind of character go to the library
MEMO_WORDS = 500_000      # words remembered per worker; the memory starts again beyond that


def version_digest(path: str) -> str:
    """Names a tokenizer by the bytes of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(vocab: dict[str, int], suffix: str = "", mark: bytes = b"") -> dict[bytes, int]:
    byte_of = _byte_of_char()
    out = {}
    for token, number in vocab.items():
        last = bool(suffix) and token.endswith(suffix)
        core = token[: -len(suffix)] if last else token
        out[bytes(byte_of[c] for c in core) + (mark if last else b"")] = number
    return out


def _may_hold_long_run(text: str) -> bool:
    words = list(map(len, text.split()))
    spaces = len(text) - sum(words)
    return max(words, default=0) >= LONG_RUN or spaces - len(words) >= LONG_RUN - 1


@lru_cache(maxsize=4)
def byte_level_counter(path: str):
    """A function text -> number of tokens for a byte-level BPE file."""
    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pre = spec["pre_tokenizer"] or {}
    plain = (
        spec["model"]["type"] == "BPE" and spec["normalizer"] is None
        and spec["post_processor"] is None and pre.get("type") == "ByteLevel"
        and pre.get("use_regex") and not pre.get("add_prefix_space")
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    )

    def slow(text: str) -> int:
        return len(exact.encode(text, add_special_tokens=False).ids)

    if not plain:
        return slow
    core = tiktoken.Encoding(
        "from-file", pat_str=BYTE_LEVEL_PATTERN,
        mergeable_ranks=_ranks({t: i for t, i in spec["model"]["vocab"].items() if t not in special}),
        special_tokens=special,
    )

    def count(text: str) -> int:
        if len(text) >= LONG_RUN and _may_hold_long_run(text):
            return slow(text)
        return len(core.encode_to_numpy(text, allowed_special="all"))

    return count


class WordCoder:
    """Ids of texts under a lower-casing word BPE that drops white space.

    Tokens never span ASCII white space there, so each chunk between such space is encoded
    once and remembered. New chunks of Latin letters (up to U+024F, where lower-casing
    and composition work per character) are encoded together by one call; the end-of-word mark
    is a zero byte, which no such chunk holds. All other chunks go to the library.
    """

    _plain = re.compile(rf"(?<!\S)(?:[!-;=-~¡-įı-ɏ]|<(?!\|)){{1,{LONG_RUN}}}(?!\S)")

    def __init__(self, path: str):
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        top = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.dtype = np.dtype("<u2") if top < 65_536 else np.dtype("<u4")
        self.memo: dict[bytes, bytes] = {}
        self.fast = None
        if self._is_word_bpe(spec):
            self.words = regex.compile(f"{WORD_PATTERN}| ")
            # a zero byte of the text itself has no place here; its own token only keeps the
            # table of single bytes complete
            self.fast = tiktoken.Encoding(
                "from-file", pat_str=r"[^\x00]+\x00", special_tokens={},
                mergeable_ranks=_ranks(vocab, spec["model"]["end_of_word_suffix"], b"\x00"),
            )
            self.space = self.fast.encode_ordinary(" \x00")[0]

    @staticmethod
    def _is_word_bpe(spec: dict) -> bool:
        parts = [p["type"] for p in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        return (
            spec["model"]["type"] == "BPE" and bool(spec["model"]["end_of_word_suffix"])
            and parts == ["NFC", "Replace", "Lowercase"] and spec["post_processor"] is None
            and pre[0].get("type") == "Split" and pre[0]["pattern"].get("Regex") == WORD_PATTERN
        )

    def _learn(self, chunks: set[bytes]) -> None:
        plain = self._plain.findall(b" ".join(chunks).decode())
        keys = list(map(str.encode, plain))
        if plain:
            pieces = self.words.findall(" ".join(plain).lower() + " ")
            ids = self.fast.encode_to_numpy("\x00".join(pieces) + "\x00")
            ends = np.flatnonzero(ids == self.space)
            if len(ends) != len(keys):
                raise RuntimeError("chunks and encoded pieces do not match")
            raw, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            starts = np.concatenate([[0], ends[:-1] + 1]) * size
            cuts = map(slice, starts.tolist(), (ends * size).tolist())
            self.memo.update(zip(keys, map(raw.__getitem__, cuts), strict=True))
        for c in chunks.difference(keys):
            self.memo[c] = self._library(c.decode())

    def _library(self, text: str) -> bytes:
        ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, packed as ``self.dtype``."""
        if self.fast is None:
            return list(map(self._library, texts))
        chunks = [t.encode().split() for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = set().union(*chunks).difference(self.memo)
        if new:
            self._learn(new)
        return [b"".join(map(self.memo.__getitem__, c)) for c in chunks]


@lru_cache(maxsize=2)
def word_coder(path: str) -> WordCoder:
    """One coder per worker process, so that tasks that follow one another share its memory."""
    return WordCoder(path)
