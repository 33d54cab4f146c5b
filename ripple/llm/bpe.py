"""Token ids as the library of a tokenizer file gives them.

``tokenizers`` is the measure. For a byte-level vocabulary whose merges come in the order of their ids,
the same ids come several times faster from ``tiktoken`` with ranks read from the same file, and are
proven equal for texts whose characters have had their class (letter, number, blank, other) in every
Unicode version. Any other text, and any text with a special string, goes to ``tokenizers``.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

BYTE_BPE = "byte_bpe_50k.json"
# characters on whose class all Unicode versions agree
_SETTLED = re.compile("[\t-\r\x20-\x7e\xa1-ſ‐-‧‰-⁞€]*")


def _byte_chars() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the
    others moved up from 256 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def _twin(path: str):
    """The same vocabulary in tiktoken, or None if the file is not of that kind."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
            or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("dropout"):
        return None
    added = {t["content"] for t in spec.get("added_tokens", [])}
    byte_of = _byte_chars()
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if len(ranks) != 256 + len(made) or any(x >= y for x, y in zip(made, made[1:])):
        return None
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


class Encoder:
    """Ids of whole texts, without begin, end or added special tokens."""

    def __init__(self, name: str):
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.library = self.twin = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.twin = _twin(path)

    def settled(self, text: str) -> bool:
        return (text.isascii() and not _ODD.search(text) or bool(_SETTLED.fullmatch(text))) \
            and not any(s in text for s in self.special)

    def ids(self, text: str) -> np.ndarray:
        if self.twin is not None and self.settled(text):
            return self.twin.encode_to_numpy(text, disallowed_special=())
        if self.library is None:
            return np.asarray(self.pieces.encode(text, num_threads=1), np.uint32)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def boundaries(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; character positions at which a word of the tokenizer begins, and the
        tokens before each."""
        found = self.library.encode(text, add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        at = np.flatnonzero((words[1:] != words[:-1]) | (words[1:] < 0)) + 1
        starts = np.array([s for s, _ in found.offsets], np.int64)
        return len(words), starts[at], at


_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f]")


@functools.cache
def encoder(name: str = BYTE_BPE) -> Encoder:
    """One per worker process."""
    return Encoder(name)
