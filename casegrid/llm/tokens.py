"""Token ids of whole texts from public tokenizer files.

The path of a file is a parameter; a task loads it once per Python worker.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from casegrid.llm.common import slices

#: Bytes of text whose distinct words are looked up together.
CHUNK_BYTES = 20 << 20


@lru_cache(maxsize=2)
def _words_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _word_ends(path: str) -> np.ndarray:
    """Whether an id ends a word."""
    vocabulary = _words_of(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
    return ends


class WordIds:
    """Ids by a tokenizer that drops white space, so that a text's ids are
    those of its words in turn: each distinct word is encoded once."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        return [x for k, e in slices(texts, CHUNK_BYTES)
                for x in self._chunk(pa.array(texts[k:e], pa.binary()).cast(pa.large_string()))]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids per word, and all ids in the order of the words.

        Words of letters alone are encoded many at a time: each of them ends
        in one id that ends a word.  Where that count differs (letters that
        change when lower-cased), and for all other words, one at a time.
        """
        tokenizer, ends = _words_of(self.path), _word_ends(self.path)
        encode = tokenizer.encode_batch_fast
        letters = [i for i, w in enumerate(words) if w.isalpha()]
        alone = [i for i, w in enumerate(words) if not w.isalpha()]
        index, sizes, parts = [], [], []
        runs = [letters[k:k + 256] for k in range(0, len(letters), 256)]
        for k in range(0, len(runs), 32):  # few at a time: an encoding is much larger than its ids
            some = runs[k:k + 32]
            for run, e in zip(some, encode([" ".join([words[i] for i in run]) for run in some],
                                           add_special_tokens=False)):
                ids = np.array(e.ids, np.int32)
                last = np.flatnonzero(ends[ids])
                if len(last) != len(run):
                    alone += run
                    continue
                index.append(np.array(run, np.int32))
                sizes.append(np.diff(last, prepend=-1))
                parts.append(ids)
        for k in range(0, len(alone), 8192):
            found = [e.ids for e in encode([words[i] for i in alone[k:k + 8192]], add_special_tokens=False)]
            index.append(np.array(alone[k:k + 8192], np.int32))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(np.array([i for x in found for i in x], np.int32))
        if not index:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        index, sizes, flat = (np.concatenate(x) for x in (index, sizes, parts))
        size = np.zeros(len(words), np.int64)
        size[index] = sizes
        start = np.zeros(len(words), np.int64)
        start[index] = np.cumsum(sizes) - sizes
        shift = start - (np.cumsum(size) - size)
        return size, flat[np.arange(len(flat)) + np.repeat(shift, size)]

    def _chunk(self, column: pa.Array) -> list[np.ndarray]:
        if not pc.any(pc.match_substring(column, "<|")).as_py():  # else a special token may be there
            # fewer distinct words: neither changes the ids
            column = pc.replace_substring_regex(pc.ascii_lower(column), r"([a-z])([.,]) ", r"\1 \2 ")
        words = pc.ascii_split_whitespace(column)
        coded = words.flatten().dictionary_encode()
        size, flat = self._encoded(coded.dictionary.to_pylist())
        first = np.concatenate(([0], np.cumsum(size)))
        which = coded.indices.to_numpy()
        lengths = size[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        take = np.repeat(first[which] - ends[:-1], lengths) + np.arange(ends[-1])
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return np.split(flat[take], bounds[1:-1])


@lru_cache(maxsize=2)
def _ranks_of(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ByteIds:
    """Ids by a byte-level rank file; any text can be restored from its ids."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        encode = _ranks_of(self.path, self.pattern).encode_ordinary
        return [np.array(encode(t.decode("utf-8", "replace")), np.int32) for t in texts]

    def text(self, ids) -> str:
        return _ranks_of(self.path, self.pattern).decode([int(i) for i in ids])
