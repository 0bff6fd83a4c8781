"""Token ids of whole texts, by a tokenizer file of the tokenizers library.

The tokenizer splits at white space before anything else, so the ids of a text
are the ids of its white-space separated pieces, one after the other. Each task
encodes the distinct pieces of a batch and remembers frequent ones.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scanloom.llm.common import coded, gathered, words_of

#: Pieces whose ids a worker remembers; beyond that they are encoded again.
REMEMBERED = 250_000

#: Marks that may close a word; the pre-tokenizer cuts between a letter or digit and a run of them.
CLOSING = ",.!?%&$*#|:;"

#: Cores that end in a letter or digit of these blocks, so that the cut is one that the pre-tokenizer makes.
SAFE_END = "[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]$"

#: Only here does lowering ASCII letters first change nothing: no combining marks, no special token's text.
PLAIN = "^[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u024f]+$"

#: The end of a document.
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: One run of letters, so one piece for the tokenizer's model too.
LETTERS = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple:
    """The tokenizer, remembered pieces, and which ids end a run of letters."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    closes = np.zeros(max(vocabulary.values()) + 1, bool)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if suffix:
        closes[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
    return tokenizer, {}, closes


def _ids(pieces: list[str], path: str) -> list[bytes]:
    """The ids of each piece as bytes of uint32."""
    tokenizer, known, closes = _loaded(path)
    ids = [known.get(w) for w in pieces]
    new = [k for k, v in enumerate(ids) if v is None]
    whole = LETTERS.fullmatch
    runs = [k for k in new if whole(pieces[k])]
    other = [k for k in new if not whole(pieces[k])]
    for at in range(0, len(runs), 2000):
        part = runs[at : at + 2000]
        row = np.array(tokenizer.encode(" ".join([pieces[k] for k in part]), add_special_tokens=False).ids, np.uint32)
        ends = (np.flatnonzero(closes[row]) + 1) * 4
        if len(ends) != len(part):  # a vocabulary without ends of words
            other += part
            continue
        data, a = row.tobytes(), 0
        for k, b in zip(part, ends.tolist()):
            ids[k] = data[a:b]
            a = b
    for at in range(0, len(other), 20_000):
        part = other[at : at + 20_000]
        for k, e in zip(part, tokenizer.encode_batch_fast([pieces[k] for k in part], add_special_tokens=False)):
            ids[k] = array("I", e.ids).tobytes()
    for k in new[: max(0, REMEMBERED - len(known))]:
        known[pieces[k]] = ids[k]
    return ids


def encoded(texts: pa.Array, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by text (one more than texts) and all ids as uint32.

    A null text is empty. ``end_id`` follows each text unless it is None.
    """
    offsets, words = words_of(texts)
    code, distinct = coded(words)
    # A distinct word is a core and closing marks; cores repeat more often than words.
    core = pc.ascii_rtrim(distinct, CLOSING)
    core = pc.if_else(pc.match_substring_regex(core, SAFE_END), core, distinct)
    cut = pc.binary_length(core).to_numpy(zero_copy_only=False)
    marks = [w[-n:] if n else "" for w, n in zip(distinct.to_pylist(), (pc.binary_length(distinct).to_numpy(zero_copy_only=False) - cut).tolist())]
    core = pc.if_else(pc.match_substring_regex(core, PLAIN), pc.ascii_lower(core), core)
    at, cores = coded(core)
    ids = _ids(cores.to_pylist(), path)
    tail_at, tails = coded(pa.array(marks, pa.string()))
    tail_ids = _ids(tails.to_pylist(), path)
    flat = np.frombuffer(b"".join(ids + tail_ids), np.uint32)
    width = np.fromiter(map(len, ids + tail_ids), np.int64, len(ids) + len(tail_ids)) // 4
    start = np.cumsum(width) - width
    pair = np.stack((at, tail_at + len(ids)), axis=1)[code].ravel()
    lengths = width[pair]
    out = flat[gathered(start[pair], lengths)]
    ends = np.concatenate(([0], np.cumsum(lengths)))[2 * offsets]
    if end_id is None:
        return ends, out
    n = len(offsets) - 1
    out = np.insert(out, ends[1:], np.uint32(end_id))
    return ends + np.arange(n + 1), out
