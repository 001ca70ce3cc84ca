"""Byte-level BPE ids of whole texts, by two libraries of the same vocabulary.

``tiktoken`` encodes whole texts fastest, but its letters are those of another
Unicode version than the vocabulary's library has.  They agree on Latin text, so
that goes through ``tiktoken`` and everything else through ``tokenizers``.  The
pre-tokenisation pattern never joins a word with the white space after it: a text
may be cut before any white space that follows a word.
"""

from __future__ import annotations

import base64
import re

import numpy as np

#: Unicode white space, as the vocabulary's pattern has it.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Letters up to U+024F are letters in every version of Unicode's tables.
_OTHER = re.compile("[^\x00-\u024f]")


class Encoder:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit bytes.

    ``path`` names the vocabulary's ``tokenizers`` file; the rank file of the
    same name, if there is one, encodes Latin stretches faster, to the same ids.
    ``limit`` is the length in characters of what is encoded at once.
    """

    def __init__(self, path: str, limit: int = 1 << 20):
        self.path, self.limit, self.slow, self.fast = path, limit, None, None
        ranks = path.removesuffix(".json") + ".tiktoken"
        try:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(ranks, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        except (ImportError, FileNotFoundError):
            pass

    def _ids(self, text: str, latin: bool) -> bytes:
        if latin and self.fast is not None:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True  # their strings in a text are ordinary text
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(text) <= self.limit and (text.isascii() or not _OTHER.search(text)):
            return self._ids(text, True) if text else b""
        out, run, size, kind = [], [], 0, True
        for chunk in _CHUNK.findall(text):
            latin = chunk.isascii() or not _OTHER.search(chunk)
            if run and (latin != kind or size + len(chunk) > self.limit):
                out.append(self._ids("".join(run), kind))
                run, size = [], 0
            run.append(chunk)
            size, kind = size + len(chunk), latin
        if run:
            out.append(self._ids("".join(run), kind))
        return b"".join(out)
