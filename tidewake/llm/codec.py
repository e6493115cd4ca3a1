"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

A text is cut at safe boundaries: a single space or line break with other
characters on both sides that are neither white space nor may combine into it.
No pretokenizer of the known files joins characters over such a boundary, so
the ids of a text are those of its pieces in turn. A slice's distinct pieces are
sent to the library in batches balanced by bytes; the ids of the first
pieces met are kept in a bounded memory of the worker process. Long texts need no care of
their own: their pieces are short, or the library gets them whole.

Where ids stand for bytes of the text as it is (byte-level, nothing normalized), pieces with
safe ends go to the library end to end, some thousand bytes at a time, with a line break
before each that begins with no space; the bytes of the ids tell which piece each is of.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import Texts

#: Bytes of a batch that the library gets, and pieces that a worker remembers (about 60 bytes each).
BATCH_BYTES, REMEMBERED = 1 << 18, 1_000_000
#: Bytes of pieces that are coded as one text.
JOINED_BYTES = 1 << 13
#: Text bytes that are coded at once: more of them share their pieces.
GROUP_BYTES = 6 << 20

SPACE, BREAK = 0x20, 0x0A
#: First bytes of UTF-8 sequences among which are white space and its like.
DOUBTFUL = np.zeros(256, bool)
DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True

_codecs: dict[str, Codec] = {}


class Codec:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.id_bytes = id_bytes(path)
        self.forget()

    def trim(self) -> None:
        """Keep the first REMEMBERED pieces: the frequent ones were met first."""
        if len(self.pieces) > REMEMBERED:
            self.pieces = pa.concat_arrays([self.pieces.slice(0, REMEMBERED), pa.array([], pa.large_binary())])
            self.bounds = self.bounds[: REMEMBERED + 1].copy()
            self.ids = self.ids[: self.bounds[-1]].copy()

    def forget(self) -> None:
        self.pieces = pa.array([], pa.large_binary())
        self.ids = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def learn(self, fresh: pa.Array) -> None:
        """Encode pieces that are not known yet, in batches of about BATCH_BYTES."""
        ids, sizes = self.joined(fresh) if self.id_bytes is not None and len(fresh) else self.each(fresh)
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.pieces = pa.concat_arrays([self.pieces, fresh])

    def each(self, fresh: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in turn, and how many each has; each is a text to the library."""
        texts = fresh.cast(pa.large_string()).to_pylist()
        cuts = np.searchsorted(np.cumsum(pc.binary_length(fresh).to_numpy()), np.arange(1, int(fresh.nbytes) // BATCH_BYTES + 1) * BATCH_BYTES).tolist()
        ids, sizes = [np.zeros(0, np.uint32)], []
        for begin, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            found = [e.ids for e in self.library.encode_batch_fast(texts[begin:end], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            sizes.extend(map(len, found))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def joined(self, fresh: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, with safe pieces end to end."""
        bounds = np.frombuffer(fresh.buffers()[1], np.int64, len(fresh) + 1, fresh.offset * 8)
        data = np.frombuffer(fresh.buffers()[2], np.uint8)
        first, last = bounds[:-1], bounds[1:] - 1
        spaced = data[first] == SPACE
        begin = data[np.minimum(first + spaced, last)]
        end, before, third = data[last], data[np.maximum(last - 1, 0)], data[np.maximum(last - 2, 0)]
        solid = lambda x: (x > 0x20) & (x != 0x7F)
        safe = solid(begin) & ~DOUBTFUL[begin] & solid(end) & ~((end >= 0x80) & (DOUBTFUL[before] | DOUBTFUL[third]))
        at = np.flatnonzero(safe)
        if not len(at):
            return self.each(fresh)
        mark = ~spaced[at]  # a line break goes before
        size = bounds[at + 1] - bounds[at] + mark
        stop = np.cumsum(size)
        text = np.full(int(stop[-1]), BREAK, np.uint8)
        inside = np.ones(len(text), bool)
        inside[(stop - size)[mark]] = False
        text[inside] = data[np.arange(int((size - mark).sum())) + np.repeat(bounds[at] - (np.cumsum(size - mark) - (size - mark)), size - mark)]
        cuts = np.unique(np.append(stop[np.searchsorted(stop, np.arange(JOINED_BYTES, int(stop[-1]), JOINED_BYTES))], stop[-1])).tolist()
        raw, batch = text.tobytes(), max(1, BATCH_BYTES // JOINED_BYTES)
        texts = [raw[a:b].decode() for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        found = [e.ids for k in range(0, len(texts), batch) for e in self.library.encode_batch_fast(texts[k : k + batch], add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        through = np.cumsum(self.id_bytes[ids])
        # Ids before the piece (its line break is one), and through it; both must end where bytes do.
        start, here = np.searchsorted(through, stop - size + mark, "left"), np.searchsorted(through, stop, "left")
        start = np.where(stop - size + mark > 0, start + 1, 0)
        edges = (through[here] == stop).all() and (through[start[start > 0] - 1] == (stop - size + mark)[start > 0]).all()
        if not edges or through[-1] != stop[-1]:
            return self.each(fresh)
        alone, alone_sizes = self.each(fresh.take(pa.array(np.flatnonzero(~safe))))
        sizes, source = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        sizes[at], source[at] = here + 1 - start, start
        sizes[~safe], source[~safe] = alone_sizes, len(ids) + np.cumsum(alone_sizes) - alone_sizes
        take = np.arange(int(sizes.sum())) + np.repeat(source - (np.cumsum(sizes) - sizes), sizes)
        return np.concatenate([ids, alone])[take], sizes

    def known(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The place of each piece of the texts, and each piece's document."""
        self.trim()
        starts, doc = pieces(texts)
        offsets = np.append(starts, len(texts.data)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(texts.data))])
        at = pc.index_in(column, value_set=self.pieces)
        if not at.null_count:
            return at.to_numpy().astype(np.int64), doc
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = column.take(pa.array(new)).dictionary_encode()
        place[new] = len(self.pieces) + fresh.indices.to_numpy()
        self.learn(fresh.dictionary)
        return place, doc

    def lengths(self, texts: Texts) -> np.ndarray:
        """The number of ids of each text."""
        if not len(texts.data):
            return np.zeros(texts.n, np.int64)
        at, doc = self.known(texts)
        return np.bincount(doc, (self.bounds[at + 1] - self.bounds[at]).astype(float), texts.n).astype(np.int64)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text's."""
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(texts.n, np.int64)
        at, doc = self.known(texts)
        begin, size = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        total = np.cumsum(size)
        source = np.arange(int(total[-1])) + np.repeat(begin - (total - size), size)
        return self.ids[source], np.bincount(doc, size.astype(float), texts.n).astype(np.int64)


def id_bytes(path: str) -> np.ndarray | None:
    """How many bytes of text each id stands for; None where a vocabulary file's ids do not stand for bytes as they are."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    plain = file.get("normalizer") is None and (file.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not file["pre_tokenizer"].get("add_prefix_space")
    if not plain or file["model"].get("type", "BPE") != "BPE":
        return None
    # A byte is one character of an entry.
    known = file["model"]["vocab"]
    out = np.zeros(max([*known.values(), *(t["id"] for t in file["added_tokens"])]) + 1, np.int64)
    for text, n in known.items():
        out[n] = len(text)
    for token in file["added_tokens"]:
        out[token["id"]] = len(token["content"].encode())
    return out


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces, and their documents; none for empty texts."""
    data = texts.data
    n = len(data)
    cut = np.zeros(n, bool)
    solid = (data > 0x20) & (data != 0x7F)
    mark = np.flatnonzero((data[1:-1] == SPACE) | (data[1:-1] == BREAK)) + 1 if n > 2 else np.zeros(0, np.int64)
    before, after = data[mark - 1], data[mark + 1]
    high = before >= 0x80
    two, three = data[np.maximum(mark - 2, 0)], data[np.maximum(mark - 3, 0)]
    safe = solid[mark - 1] & solid[mark + 1] & ~DOUBTFUL[after] & ~(high & (DOUBTFUL[two] | DOUBTFUL[three]))
    mark = mark[safe]
    cut[mark] = True
    breaks = mark[data[mark] == BREAK]
    cut[breaks + 1] = True
    first = texts.bounds[:-1]
    cut[first[first < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(texts.bounds, starts, "right") - 1


def codec(path: str) -> Codec:
    """The worker's codec for a vocabulary file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]
