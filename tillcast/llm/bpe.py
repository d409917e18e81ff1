"""Byte-pair encoding and decoding by prefix-sharing trie traversal.

The distinct words of a task's texts are visited in the depth-first order of
their trie (sorted order: a node's subtree is the run of words that share its
prefix). At each node, a prefix, one state is kept: the last token of the
encoding of that prefix. A child's state follows from its ancestors' states:
it is the one vocabulary token that ends there and that byte-pair merging
would leave standing next to the state at the node where the token begins.
So a shared prefix is worked out once, and a word's encoding is read off by
walking back from its own node.

Words are those of the byte-level pattern, found for a whole batch of texts
at once from the classes of neighbouring characters; special tokens in a text
are tokens of their own. Equal words of a batch are brought together by a
64-bit hash, and the decoded bytes are compared with the text, so a collision
only costs time. The vocabulary file is a parameter; its bytes are broadcast
(a few MB, independent of the data). No shuffle: each worker keeps the words
it has met in a table of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import BYTE_NUMBERS, pieces, ragged, span_hashes, text_buffers

#: Words that a worker keeps between batches; when full it starts again.
TABLE_WORDS = 400_000

_SCHEMA = "doc_id long, ids binary, decoded string"


def byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for the 256 bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens numbered in merge order: 0-255 the bytes, then one token for each merge."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.number = {bytes([b]): b for b in range(256)}
        self.left, self.right, self.joined = list(range(256)), list(range(256)), {}
        for merge in spec["model"]["merges"]:
            a, b = map(to_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            new = len(self.left)
            x, y = self.number[a], self.number[b]
            self.number[a + b] = new
            self.left.append(x)
            self.right.append(y)
            self.joined[x, y] = new
        self.ids = [0] * len(self.left)
        self.size = [0] * len(self.left)
        for token, n in self.number.items():
            self.ids[n] = vocab[token]
            self.size[n] = len(token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.spelled = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        # reversed trie of the tokens: walking back from a place in a word meets all tokens that end there
        self.ending: dict = {}
        for token, n in self.number.items():
            node = self.ending
            for b in reversed(token):
                node = node.setdefault(b, {})
            node[-1] = n
        self.known_pairs: dict[tuple[int, int], bool] = {}

    def stand(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` side by side.

        Undo merges on both sides of the border, latest first. If at some
        moment the two pieces that touch there have a merge that comes before
        the next one undone, merging would have taken it.
        """
        key = (a, b)
        if key in self.known_pairs:
            return self.known_pairs[key]
        left, right, joined = self.left, self.right, self.joined
        until, ok = len(left), True
        while True:
            m = joined.get((a, b))
            if m is not None and m < until:
                ok = False
                break
            if a > b and a >= 256:  # the left piece was made last
                until, a = a, right[a]
            elif b >= 256:  # of equal merges the left one is made first
                until, b = b + 1, left[b]
            elif a >= 256:
                until, a = a, right[a]
            else:
                break
        if len(self.known_pairs) > 2_000_000:
            self.known_pairs.clear()
        self.known_pairs[key] = ok
        return ok

    def encode_sorted(self, words: list[bytes]):
        """Encodings (as numbers) of sorted distinct words, one after the other."""
        size, ending, stand, known = self.size, self.ending, self.stand, self.known_pairs
        last: list[int] = [-1]
        before = b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            for i in range(shared, len(word)):
                node, j, found = ending, i, []
                while j >= 0:
                    node = node.get(word[j])
                    if node is None:
                        break
                    n = node.get(-1)
                    if n is not None:
                        found.append((j, n))
                    j -= 1
                for start, n in reversed(found):
                    prior = last[start]
                    if prior < 0:
                        break
                    ok = known.get((prior, n))
                    if ok is None:
                        ok = stand(prior, n)
                    if ok:
                        break
                last.append(n)
            before = word
            out, at = [], len(word)
            while at:
                n = last[at]
                out.append(n)
                at -= size[n]
            out.reverse()
            yield out


LETTER, NUMBER, BLANK, SPACE, OTHER = 1, 2, 3, 4, 5
# The white space of the word pattern.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the word pattern cuts off with their apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    import unicodedata

    out = np.full(0x110000, OTHER, np.uint8)
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    out[kinds == "L"] = LETTER
    out[kinds == "N"] = NUMBER
    out[WHITE] = SPACE
    out[0x20] = BLANK
    return out


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the place of each one's first byte."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    b = raw[lead].astype(np.uint32)
    cp = b.copy()
    for low, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero((b >= low) & (b < (low + 0x20 if more == 1 else low + 0x10)))
        if len(at):
            v = b[at] & mask
            for k in range(1, more + 1):
                v = (v << np.uint32(6)) | (raw[lead[at] + k] & np.uint32(0x3F))
            cp[at] = v
    return cp, lead


def word_starts(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the words of the byte-level pattern start, in bytes; ``rows`` are the starts of the (non-empty) texts.

    A word is a run of letters, of numbers or of other signs, with the blank
    before it. Of a run of white space the last character is on its own (a
    blank joins the word after it) unless the text ends there. An apostrophe
    that starts a word takes one of the fixed endings.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    cp, lead = code_points(raw)
    kind = classes()[np.minimum(cp, 0x10FFFF)]
    n = len(kind)
    first = np.zeros(n + 3, bool)
    first[np.searchsorted(lead, rows)] = True
    first[n:] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 0, kind[:-1]
    before[first[:n]] = 0
    after = np.zeros(n, np.uint8)
    after[:-1] = kind[1:]
    after[first[1:n + 1]] = 0
    white = (kind == BLANK) | (kind == SPACE)
    white_before = (before == BLANK) | (before == SPACE)
    start = np.where(white, ~white_before | ((after != 0) & (after != BLANK) & (after != SPACE)),
                     (before != kind) & (before != BLANK))
    start[first[:n]] = True
    mark = np.flatnonzero((cp == 0x27) & (before != OTHER) & (before != BLANK) & (after == LETTER))
    if len(mark):
        padded = np.concatenate([cp, np.zeros(3, cp.dtype)])
        for ending in ENDINGS:
            k = len(ending)
            hit = mark[np.all([(padded[mark + 1 + j] == ord(c)) & ~first[mark + 1 + j] for j, c in enumerate(ending)], axis=0)]
            start[hit + 1] = False
            more = hit + 1 + k
            start[more[more < n]] = True
    return lead[start]


class Encoder:
    """Encodes and decodes whole texts; keeps met words in a table of bounded size."""

    def __init__(self, raw: bytes):
        self.vocab = Vocabulary(raw)
        spelled = self.vocab.spelled
        most = max(spelled) + 1
        self.spelled_size = np.array([len(spelled.get(i, b"")) for i in range(most)], np.int64)
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size
        self.spelled_bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(most)), np.uint8)
        self.special = {t.encode(): i for t, i in self.vocab.special.items()}
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")") if self.special else None
        self.reset()

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.start = array("I"), array("q", [0])

    def learn(self, words: list[bytes]) -> None:
        """Add sorted distinct words to the table."""
        ids = self.vocab.ids
        for word, numbers in zip(words, self.vocab.encode_sorted(words), strict=True):
            self.index[word] = len(self.index)
            self.flat.extend([ids[n] for n in numbers])
            self.start.append(len(self.flat))

    def encode(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (unsigned 32 bit), and where each text's ids start (rows + 1)."""
        raw = raw[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if self.cut is not None and any(raw.tobytes().find(s) >= 0 for s in self.special):
            return self._encode_special(offsets, raw)
        ids, per_word, starts = self._encode_plain(offsets, raw)
        ends = np.concatenate([[0], np.cumsum(per_word)])
        return ids, ends[np.searchsorted(starts, offsets)]

    def _encode_plain(self, offsets, raw):
        starts = word_starts(raw, np.unique(offsets[:-1][np.diff(offsets) > 0]))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), starts
        keys, where, back = np.unique(span_hashes(BYTE_NUMBERS[raw], starts), return_index=True, return_inverse=True)
        ends = np.append(starts[1:], len(raw))
        view = raw.tobytes()
        words = [view[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        ids, per_word = self._look_up(words, back)
        if not np.array_equal(self.decode_bytes(ids), raw):  # two words share a hash: take every word by itself
            words = [view[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            ids, per_word = self._look_up(words, np.arange(len(words)))
        return ids, per_word, starts

    def _look_up(self, words: list[bytes], back: np.ndarray):
        if len(self.index) > TABLE_WORDS:
            self.reset()
        new = {w for w in words if w not in self.index}
        self.learn(sorted(new))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        flat, start = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.start, np.int64)
        first = start[at]
        size = (start[at + 1] - first)[back]
        ids = flat[ragged(first[back], size)]
        del flat, start
        return ids, size

    def _encode_special(self, offsets, raw):
        """Texts that hold special tokens, cut at them."""
        out, places = [], [0]
        view = raw.tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            total = 0
            for k, part in enumerate(self.cut.split(view[a:b])):
                if k % 2:
                    got = np.array([self.special[part]], np.uint32)
                else:
                    got = self._encode_plain(np.array([0, len(part)]), np.frombuffer(part, np.uint8))[0]
                out.append(got)
                total += len(got)
            places.append(places[-1] + total)
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.array(places)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return self.spelled_bytes[ragged(self.spelled_start[ids], self.spelled_size[ids])]

    def decode(self, ids: np.ndarray, places: np.ndarray) -> pa.Array:
        """The texts of runs of ids, bytes that are no UTF-8 replaced."""
        size = np.concatenate([[0], np.cumsum(self.spelled_size[ids])])[places]
        raw = self.decode_bytes(ids).tobytes()
        try:
            raw.decode("utf-8")
            texts = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(size.astype(np.int64).tobytes()), pa.py_buffer(raw))
            texts.validate(full=True)
        except (UnicodeDecodeError, pa.ArrowInvalid):
            texts = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(size[:-1].tolist(), size[1:].tolist(), strict=True)], pa.large_string())
        return texts


_encoders: dict[bytes, Encoder] = {}


def encoder(raw: bytes) -> Encoder:
    """One encoder for each vocabulary and worker."""
    key = hashlib.sha256(raw).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(raw)
    return _encoders[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text", id_col: str = "doc_id",
           decoded: bool = True) -> DataFrame:
    """(doc_id, ids, decoded), one row per row: ids as little-endian unsigned 32-bit
    integers in a binary column, and the text that decoding them gives
    (``decoded=False`` leaves it null).

    A null or empty text has no ids and decodes to the empty text. Rows that
    repeat are encoded like any other; a null doc_id stays null. Other columns
    are not read. ``vocabulary`` is a path on the driver.
    """
    raw = open(vocabulary or default_vocabulary(), "rb").read()
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches):
        enc = encoder(shared.value)
        for piece in pieces(batches, 1):
            ids, places = enc.encode(*text_buffers(piece.column(1)))
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), piece.num_rows, [
                None, pa.py_buffer((places * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            back = enc.decode(ids, places).cast(pa.string()) if decoded else pa.nulls(piece.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([piece.column(0), coded.cast(pa.binary()), back], names=["doc_id", "ids", "decoded"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, _SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return encode(docs).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
