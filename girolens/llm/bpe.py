"""Byte-level BPE encoding and decoding by tree reduction.

A text is halved until its parts are short, the parts are encoded on their own, and neighbours are joined on the way
up. At a join only a window around the boundary is encoded again. It grows until the tokens outside it cannot change:

* A cut between two characters of different kind (letter, number, other; white space only on the right) is a match
  boundary of the split pattern whatever stands around it. A window from such a cut to such a cut is final.
* Inside one long match there is no such cut. There the window grows in tokens; it is final when the pairs of tokens
  on its two edges are what their joined bytes encode to, because a sequence of tokens is the encoding of its bytes
  if and only if each pair of neighbours is.
* Where neither holds (long runs of white space), the window grows to the whole of both parts.

Decoding concatenates the bytes of the tokens up the same kind of tree.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from girolens.llm.common import mapped

LEAF = 4096
_WHITE = frozenset("\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))


@functools.lru_cache(1 << 14)
def _kind(c: str) -> str:
    """L, N, S (white space), O (other), or ? for unassigned characters, which newer tables may class anew."""
    if c in _WHITE:
        return "S"
    category = unicodedata.category(c)
    return category[0] if category[0] in "LN" else "?" if category == "Cn" else "O"


def _is_cut(text: str, p: int) -> bool:
    a, b = text[p - 1], text[p]
    x, y = _kind(a), _kind(b)
    return x != y and x in "LNO" and y != "?" and not (a == "'" and y == "L")


class Codec:
    """Encodes texts and decodes ids with the ranks of a file of base64 tokens."""

    def __init__(self, file: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._leaf = leaf
        self._coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {i: token for token, i in ranks.items()}
        self._fits = functools.lru_cache(1 << 16)(self._pair)

    def encode(self, text: str) -> list[int]:
        return self._tree(text, 0, len(text))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self._leaf:
            return self._coder.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def _tree(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self._leaf:
            return self._coder.encode_ordinary(text[low:high])
        middle = (low + high) // 2
        return self._join(text, low, middle, high, self._tree(text, low, middle), self._tree(text, middle, high))

    def _join(self, text: str, low: int, middle: int, high: int, left: list[int], right: list[int]) -> list[int]:
        if middle == low or middle == high:
            return left + right
        reach = 16
        a = b = None
        while a is None or b is None:
            if a is None:
                start = max(low, middle - reach)
                a = next((p for p in range(middle, max(start, low + 1) - 1, -1) if _is_cut(text, p)), None)
                a = low if a is None and start == low else a
            if b is None:
                end = min(high, middle + reach)
                b = next((p for p in range(middle, min(end, high - 1) + 1) if _is_cut(text, p)), None)
                b = high if b is None and end == high else b
            if reach == 1024 and (a is None or b is None):
                joined = self._inside(text, middle, left, right) if self._one_kind(text, middle, reach) else None
                if joined is not None:
                    return joined
            reach *= 4
        if a == b:
            return left + right
        left, right = left[: self._without(left, text[a:middle], -1)], right[self._without(right, text[middle:b], 1) :]
        return left + self._coder.encode_ordinary(text[a:b]) + right

    def _without(self, ids: list[int], part: str, step: int) -> int:
        """Where `ids` has to be cut so that the bytes of `part` go from its end (step -1) or its start (step 1)."""
        rest, at = len(part.encode()), len(ids) if step < 0 else 0
        while rest > 0:
            rest -= len(self._bytes[ids[at - 1 if step < 0 else at]])
            at += step
        assert rest == 0, "a cut has to be a token boundary"
        return at

    def _one_kind(self, text: str, middle: int, reach: int) -> bool:
        kinds = {_kind(c) for c in text[max(0, middle - reach) : middle + reach]}
        return len(kinds) == 1 and kinds <= set("LNO")

    def _pair(self, a: int, b: int) -> bool:
        return self._piece(self._bytes[a] + self._bytes[b]) == [a, b]

    def _piece(self, piece: bytes) -> list[int]:
        return self._coder._core_bpe.encode_single_piece(piece)

    def _inside(self, text: str, middle: int, left: list[int], right: list[int]) -> list[int] | None:
        """Joins within one match; None if the window would leave the characters known to be of one kind."""
        n = 1
        while True:
            i, j = max(0, len(left) - n), min(n, len(right))
            span = sum(len(self._bytes[x]) for x in left[max(0, i - 1) :] + right[: j + 1])
            if i == 0 or j == len(right) or span > 1000:
                return None
            window = self._piece(b"".join(self._bytes[x] for x in left[i:] + right[:j]))
            if self._fits(left[i - 1], window[0]) and self._fits(window[-1], right[j]):
                return left[:i] + window + right[j:]
            n *= 2


@functools.lru_cache(4)
def codec(name: str) -> Codec:
    """The codec of a public rank file, once per Python worker."""
    import public_tokenizers

    return Codec(public_tokenizers.path(name), public_tokenizers.PATTERN)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = "byte_bpe_50k.tiktoken",
           digests: bool = True) -> DataFrame:
    """One row per row of `docs`: key, n_tokens, and ids with decoded bytes, or their digests.

    Null and empty texts give no ids and the digests of nothing. Repeated rows give repeated rows; other columns are
    not read. Very long texts are encoded whole, by halves; an empty table gives an empty one. Each row is encoded on
    its own, so nothing is shuffled and a lost task is simply run again.
    """
    kind = dict(docs.select(key).dtypes)[key]
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks)
        digits = [str(i) for i in range(1 << 16)]
        schema = pa.schema([("n_tokens", pa.int64()), ("a", pa.string() if digests else pa.list_(pa.int32())),
                            ("b", pa.string() if digests else pa.binary())])
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[list] = [[], [], []]
                for value in part.column(1):
                    ids = coder.encode(value.as_py() or "")
                    decoded = coder.decode(ids)
                    rows[0].append(len(ids))
                    if digests:
                        shown = " ".join(map(digits.__getitem__, ids))
                        rows[1].append(hashlib.sha256(shown.encode()).hexdigest())
                        rows[2].append(hashlib.sha256(decoded).hexdigest())
                    else:
                        rows[1].append(ids)
                        rows[2].append(decoded)
                cells = [pa.array(r, f.type) for r, f in zip(rows, schema, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cells], names=names)

    names = [key, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    return mapped(docs.select(key, text), run, f"`{key}` {kind}, n_tokens long, {rest}")
