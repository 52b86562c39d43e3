"""Token ids of whole texts, by a public tokenizer file.

White space never joins two words of a byte-level BPE, so where no two white-space characters
meet, a text is cut before each space and around each line end, and the ids of the pieces come
from a bounded cache; only new pieces are encoded. Other texts are encoded whole. New pieces go
through the same merges in ``tiktoken``, which is faster on short strings, if the file's ids are
in merge order, and through ``tokenizers`` otherwise. The ids equal those of ``tokenizers`` on
the whole text (tested).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k.json"
END_OF_DOCUMENT = 0
_MEETING_SPACES = re.compile(r"\s\s|\0")
# Bytes of ASCII white space, and the first bytes of longer white-space characters.
_SPACES = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_MAYBE_SPACES = np.isin(np.arange(256), [0, 0xC2, 0xE1, 0xE2, 0xE3])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of each token by id, if the ids are in merge order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if [vocab.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
    return ranks if len(ranks) == 256 + len(merges) else None


class IdCache(dict):
    """Piece of text -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode = encode
        self.most = most

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > 2 and piece[-1] in ",." and piece[-2].isalpha():
            ids = self[piece[:-1]] + self[piece[-1]]
        else:
            ids = np.array(self.encode(piece), dtype="<u4").tobytes()
        if len(piece) <= 12:  # longer ones seldom come back
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """``ids(text)``: the ids of a text as bytes, four per id."""

    def __init__(self, path: str | None = None, most_pieces: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = path or default_tokenizer()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        #: The first value that is no id: flat files hold it for the ordinary id 0.
        self.spare = max(self.tokenizer.get_vocab().values()) + 1
        ranks = _merge_ranks(path)
        if ranks is None:
            short = self.whole
        else:
            import public_tokenizers
            import tiktoken

            merges = tiktoken.Encoding(
                "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

            def short(piece: str) -> list[int]:
                if piece[:1] == " " and piece[1:].isalpha():  # one piece to the pattern too
                    return merges._encode_single_piece(piece)
                return merges.encode_ordinary(piece)

        self.cache = IdCache(short, most_pieces)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _MEETING_SPACES.search(text):
            return np.array(self.whole(text), dtype="<u4").tobytes()
        pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.cache.__getitem__, filter(None, pieces)))

    def flat_ids(self, text: str) -> np.ndarray:
        """Ids of a text as flat files hold them, two bytes each. The end of a document is 0 there,
        which is also the id of an ordinary token: that one is stored as ``spare``."""
        if self.spare > 0xFFFF:
            raise ValueError("flat files hold two bytes an id, and this tokenizer has too many ids")
        ids = np.frombuffer(self.ids(text), dtype="<u4")
        return np.where(ids == END_OF_DOCUMENT, self.spare, ids).astype("<u2")

    def flat_batch(self, texts: list[str]) -> list[np.ndarray]:
        """``flat_ids`` of each text. The texts are cut as one run of bytes, and each distinct piece
        of them is looked up once."""
        data = [t.encode() for t in texts]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        stops = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(data), dtype=np.uint8)
        space = _SPACES[raw]
        text_at = np.zeros(len(raw), dtype=bool)
        text_at[(stops - sizes)[sizes > 0]] = True
        meeting = np.flatnonzero(space[1:] & space[:-1] & ~text_at[1:])
        apart = set(np.searchsorted(stops, meeting, "right").tolist())
        doubtful = set(np.searchsorted(stops, np.flatnonzero(_MAYBE_SPACES[raw]), "right").tolist())
        apart |= {k for k in doubtful - apart if _MEETING_SPACES.search(texts[k])}
        line_end = raw == 10
        begins = text_at | (raw == 32) | line_end
        begins[1:] |= line_end[:-1]
        starts = np.flatnonzero(begins)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)]
        ).dictionary_encode()
        found = [self.cache[p.decode()] for p in pieces.dictionary.to_pylist()]
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        pool = np.where(pool == END_OF_DOCUMENT, self.spare, pool).astype("<u2")
        size = np.array([len(f) // 4 for f in found], dtype=np.int64)
        start = np.cumsum(size) - size
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        sizes_of = size[codes] if len(codes) else np.zeros(0, dtype=np.int64)
        ends = np.cumsum(sizes_of)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[codes] - (ends - sizes_of), sizes_of)
        ids = pool[take]
        last_piece = np.searchsorted(starts, stops, "left")  # pieces before each text's end
        bounds = np.append(0, ends)[last_piece]
        out = [ids[a:b] for a, b in zip(np.append(0, bounds[:-1]), bounds)]
        for k in apart:
            out[k] = self.flat_ids(texts[k])
        return out

    def restored(self, flat: np.ndarray) -> np.ndarray:
        """The tokenizer's ids of one document's ids from a flat file, its end left out."""
        return np.where(flat == self.spare, END_OF_DOCUMENT, flat)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One per Python worker and file."""
    key = path or ""
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path)
    return _ENCODERS[key]
