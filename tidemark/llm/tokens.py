"""Token ids of whole texts under the public byte-level vocabulary, exact and fast on repeated words."""

from __future__ import annotations

import base64
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k"
#: A space after white space may belong to the run before it, and these strings are special tokens:
#: such texts go to the tokenizer whole.
IRREGULAR = r"\s\x20|^\x20|[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{85}\x{0B}\x{1C}-\x{1F}]|<\|"
#: Letters on which both encoders' Unicode tables surely agree.
LATIN = re.compile("[\x00-ɏ]*").fullmatch
#: Words whose ids are put in their places at once.
STEP = 1 << 16


def _file(folder: str | None, name: str) -> str:
    import public_tokenizers

    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _whole(folder: str | None):
    """The tokenizer itself: only workers that meet a text or word for it hold it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_file(folder, f"{VOCABULARY}.json"))


@lru_cache(maxsize=2)
def _words(folder: str | None):
    """The public ranks, for words of which both encoders surely think alike."""
    import public_tokenizers
    import tiktoken

    with open(_file(folder, f"{VOCABULARY}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ids(text: str, folder: str | None) -> np.ndarray:
    """Ids of a text under the tokenizer itself."""
    return np.array(_whole(folder).encode(text, add_special_tokens=False).ids, np.int32)


def encode(texts: pa.Array, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end, and the n + 1 offsets of the texts. Null texts have no ids.

    The vocabulary's pre-tokens begin at a single space or after one, never across it, so a text is encoded
    word by word, and each distinct word of the batch once. Texts with other spacing are encoded whole.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    odd = pc.match_substring_regex(texts, IRREGULAR).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
    split = pc.split_pattern(plain, " ")
    offsets = split.offsets.to_numpy()
    parts = split.flatten().dictionary_encode()
    codes = parts.indices.to_numpy().astype(np.int64)
    first = np.zeros(len(codes), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    # a word that opens a text has no space before it: twice the dictionary, without and with the space
    codes = codes * 2 + ~first
    used = np.zeros(2 * len(parts.dictionary), bool)
    used[codes] = True
    codes = (np.cumsum(used) - 1)[codes]
    distinct, flat, sizes = parts.dictionary.to_pylist(), array("i"), array("q")
    for c in np.flatnonzero(used).tolist():
        word = " " * (c & 1) + distinct[c >> 1]
        ids = _words(folder).encode_ordinary(word) if LATIN(word) else _whole(folder).encode(word, add_special_tokens=False).ids
        flat.extend(ids)
        sizes.append(len(ids))
    distinct = parts = split = plain = None
    flat, sizes = np.array(flat, np.int32), np.array(sizes, np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    lengths = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    out, bounds = np.empty(int(ends[-1]), np.int32), ends[offsets]
    for at in range(0, len(codes), STEP):
        own, until = slice(at, at + STEP), min(at + STEP, len(codes))
        gather = np.repeat(begins[codes[own]] - ends[at:until], lengths[own]) + np.arange(ends[at], ends[until])
        out[ends[at] : ends[until]] = flat[gather]
    if not odd.any():
        return out, bounds
    # one text after the other: what the tokenizer returns takes some hundred bytes a token
    rest = {i: _ids(texts[i].as_py(), folder) for i in np.flatnonzero(odd).tolist()}
    rows = [rest[i] if i in rest else out[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
