"""Byte-level BPE over Arrow batches, with offsets, and decoding.

A rank file is turned into a model of the tokenizers library: bytes become printable
characters by the usual byte table, and every split of a token into two tokens becomes
a merge of that token's rank.  Texts are cut into chunks where a match of the pattern
always ends, so that each worker encodes a distinct chunk once: at single spaces and, for
the usual pattern, between ASCII letters, digits, marks and line ends.  Texts with spaces
after white space, where that does not hold, are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spans import Words, release, same_spans, slices, text_bytes

#: Pieces and chunks kept by a worker, and ids of the chunks.  A full store is emptied, so these bound
#: memory only (about 70 MB).
CACHE = 50_000
CHUNKS = 800_000
POOL = 4_000_000


def byte_chars() -> list[str]:
    """The character of each byte: itself where printable, else one from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in keep else chr(extra))
        extra += b not in keep
    return out


CHARS = byte_chars()
TO_CHARS = dict(enumerate(CHARS))
TO_BYTES = {ord(c): b for b, c in enumerate(CHARS)}
#: The same characters as code points.
SHOWN = np.array([ord(c) for c in CHARS], "<u4")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def visible(raw: bytes) -> str:
    return raw.decode("latin-1").translate(TO_CHARS)


def _visible_text(text: str) -> str:
    """The same of a text; of printable ASCII only the space changes."""
    return text.replace(" ", CHARS[32]) if text.isascii() and text.isprintable() else visible(text.encode())


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                merges.append((visible(left), visible(right)))
    out = Tokenizer(models.BPE(vocab={visible(t): r for t, r in ranks.items()}, merges=merges))
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return out


def tokenizer_from_json(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


#: White space as Unicode has it.
_WHITE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Texts with a space at either end or after white space: they are cut by the pattern alone.
_UNEVEN = rf"(?:\A|{_WHITE}) | \z"
#: The pattern of byte-level BPE whose matches are known to end between certain ASCII bytes.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER, _LETTER, _DIGIT, _MARK, _LINE, _SPACE = range(6)


def _kinds() -> np.ndarray:
    """Letter, digit, mark, white space or the space itself; bytes of longer characters are other."""
    out = np.full(256, _OTHER, np.uint8)
    out[:128] = _MARK
    for chars, kind in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", _LETTER), (b"0123456789", _DIGIT), (b"\t\n\x0b\x0c\r", _LINE), (b" ", _SPACE)):
        out[list(chars)] = kind
    return out


def _ends(usual: bool) -> np.ndarray:
    """1 where a match ends between two bytes (first * 256 + second), 2 where one begins before the first as well.

    Before a space one ends in any text that is not uneven.  Of the usual pattern, matches
    hold ASCII characters of one kind, but for a space before and an apostrophe with
    letters.  Of white space before something else, the last character stands alone.
    """
    kind = _kinds()
    out = np.zeros((256, 256), np.uint8)
    if usual:
        plain = (kind >= _LETTER) & (kind <= _MARK)
        out[(kind[:, None] != kind) & plain[:, None] & plain] = 1
        out[ord("'"), kind == _LETTER] = 0
        out[np.ix_(plain, kind == _LINE)] = 1
        out[np.ix_(kind == _LINE, plain)] = 2
    out[:, ord(" ")] = 1
    return out.ravel()


#: Bytes of text taken at once.
PART = 1 << 21
#: Rows of an Arrow batch taken at once.
ROWS = 1000


class Encoder:
    """Ids of texts; chunks met before are looked up by hash in sorted arrays, and compared byte by byte."""

    def __init__(self, tokenizer, pattern: str):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # Unicode's White_Space, as the tokenizers' own engines read \s.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        usual = pattern == USUAL
        self._ends = _ends(usual)
        # A chunk with none of these bytes is one match.
        self._hard = np.isin(_kinds(), (_OTHER, _LINE)) if usual else np.ones(256, bool)
        self._hard[ord("'")] = True
        self.pieces: dict[str, list[int]] = {}
        self._forget()

    def close(self) -> None:
        """Empty the stores; the model stays for the worker's next task."""
        self.pieces.clear()
        self._forget()
        release()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        # The chunks themselves: where each begins, how long it is, and all their bytes.
        self.chunk_at = np.zeros(0, np.int32)
        self.chunk_size = np.zeros(0, np.int32)
        self.bytes = np.zeros(0, np.uint8)

    def _piece(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is None:
            found = [t.id for t in self.model.tokenize(_visible_text(piece))]
            if len(piece) <= 64:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found

    def ids(self, text: str) -> list[int]:
        """Ids of one text or chunk, each match of the pattern separately."""
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self._piece(piece)
        return out

    def _chunk_ids(self, data: np.ndarray, size: np.ndarray) -> Iterator[list[int]]:
        """Ids of chunks that lie one after the other."""
        ends = np.cumsum(size)
        hard = np.logical_or.reduceat(self._hard[data], ends - size)
        raw, shown, tokenize = data.tobytes(), SHOWN[data].tobytes().decode("utf-32-le"), self.model.tokenize
        for lo, hi, more in zip((ends - size).tolist(), ends.tolist(), hard.tolist(), strict=True):
            if more:
                text = raw[lo:hi].decode()
                if not (text[1:].isalpha() and (text[0] == " " or text[0].isalpha())):
                    yield self.ids(text)
                    continue
            yield [t.id for t in tokenize(shown[lo:hi])]  # the chunk is kept as a whole

    def _add(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Put ids of new chunks into the pool; where they begin, and how many."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), total), np.uint32)])
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        at = self.used + np.cumsum(size) - size
        self.used += total
        return at, size

    def _lookup(self, own: np.ndarray, lo: np.ndarray, length: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each chunk (`length` bytes of `own` from `lo`) begin, and how many."""
        distinct, one, every = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == distinct[inside]
        at, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        at[known], size[known] = self.at[where[known]], self.size[where[known]]
        # The bytes behind each distinct hash, in the store or in these texts.
        stored = where[known]
        equal = np.ones(len(hashes), bool)
        of_store = known[every]
        chunk_at, chunk_size = lo[one], length[one]
        full_at, full_size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        full_at[known], full_size[known] = self.chunk_at[stored], self.chunk_size[stored]
        for part, source, begin, much in ((of_store, self.bytes, full_at, full_size), (~of_store, own, chunk_at, chunk_size)):
            i = np.flatnonzero(part)
            equal[i] = much[every[i]] == length[i]
            i = i[equal[i]]
            equal[i] = same_spans(own, lo[i], source, begin[every[i]], length[i])
        if len(new := np.flatnonzero(~known)):
            ends = np.cumsum(chunk_size[new])
            taken = own[np.arange(ends[-1]) + np.repeat(chunk_at[new] - ends + chunk_size[new], chunk_size[new])]
            at[new], size[new] = self._add(list(self._chunk_ids(taken, chunk_size[new])))
            place = len(self.bytes) + ends - chunk_size[new]
            self.bytes = np.concatenate([self.bytes, taken])
            put = where[new]
            self.keys = np.insert(self.keys, put, distinct[new])
            self.at, self.size = np.insert(self.at, put, at[new]), np.insert(self.size, put, size[new])
            self.chunk_at, self.chunk_size = np.insert(self.chunk_at, put, place), np.insert(self.chunk_size, put, chunk_size[new])
        at, size = at[every], size[every]
        if len(other := np.flatnonzero(~equal)):  # another chunk with the same hash
            raw = own.tobytes()
            at[other], size[other] = self._add([self.ids(raw[a:b].decode()) for a, b in zip(lo[other].tolist(), (lo + length)[other].tolist(), strict=True)])
        return at, size

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """Chunks of some texts: all their bytes, cut where a match ends."""
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        ends = self._ends[(data[:-1].astype(np.uint16) << 8) | data[1:]] if n else np.zeros(0, np.uint8)
        cut = first.copy()
        cut[1:n] |= ends > 0
        alone = np.flatnonzero(ends == 2)
        cut[alone[~first[alone + 1]]] = True  # not over a text's end
        edges = np.flatnonzero(cut)
        return Words(data, offsets, edges[:-1], edges[1:], fold=False)

    def column(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row ranges of a text column with their ids and each row's number of ids."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        uneven = np.asarray(pc.match_substring_regex(column, _UNEVEN))
        data, offsets = text_bytes(column)
        for lo, hi in slices(offsets, PART):
            if len(self.keys) > CHUNKS or self.used > POOL or len(self.bytes) > 4 * POOL:
                self._forget()
            rows, edges = hi - lo, offsets[lo : hi + 1]
            chunks = self._chunks(data[edges[0] : edges[-1]], edges - edges[0])
            row, start, end, hashes = chunks.row, chunks.start, chunks.end, chunks.hash
            odd = np.flatnonzero(uneven[lo:hi])
            if len(odd):
                even = ~uneven[lo:hi][row]
                row, start, end, hashes = row[even], start[even], end[even], hashes[even]
            at, size = self._lookup(chunks.data, start, end - start, hashes)
            if len(odd):
                more_at, more_size = self._add([self.ids(column[lo + int(r)].as_py()) for r in odd])
                row, at, size = np.concatenate([row, odd]), np.concatenate([at, more_at]), np.concatenate([size, more_size])
                order = np.argsort(row, kind="stable")
                row, at, size = row[order], at[order], size[order]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.pool[np.arange(total) + np.repeat(at - ends + size, size)]
            yield lo, hi, ids, np.bincount(row, weights=size, minlength=rows).astype(np.int64)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a vocabulary file (.json, or ranks)."""
    if (path, pattern) not in _ENCODERS:
        made = tokenizer_from_json(path) if path.endswith(".json") else tokenizer_from_ranks(read_ranks(path), pattern)
        _ENCODERS[path, pattern] = Encoder(made, pattern)
        release()
    return _ENCODERS[path, pattern]


def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id, by reversing the byte table."""
    if path.endswith(".json"):
        vocab = tokenizer_from_json(path).get_vocab(with_added_tokens=False)
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = bytes(TO_BYTES[ord(c)] for c in token)
        return out
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


class Decoder:
    """Bytes of ids, gathered from one table of all tokens' bytes."""

    def __init__(self, path: str):
        tokens = token_bytes(path)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.table = np.frombuffer(b"".join(tokens), np.uint8)

    def raw(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        ends = np.cumsum(n)
        if not len(ends):
            return b""
        return self.table[np.arange(ends[-1]) + np.repeat(self.at[ids] - ends + n, n)].tobytes()


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def character_spans(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last character of each token; tokens that share a split character both cover it."""
    b = np.frombuffer(raw, np.uint8)
    # character of each byte: the number of characters begun so far, less one
    char = np.cumsum((b & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    return char[starts], char[ends - 1] + 1


def _schema(df: DataFrame, fields: list[T.StructField]) -> tuple[list[str], list[str], T.StructType]:
    names = [f.name for f in fields]
    kept = [c for c in df.columns if c not in names]
    return kept, names, T.StructType([df.schema[c] for c in kept] + fields)


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", offsets: bool = False, decoded: bool = False) -> DataFrame:
    """Add `ids` (binary, little-endian unsigned 32-bit) and `n_tokens` of a text column.

    With `offsets`, also `spans`: the first and past-last character of every token; with
    `decoded`, also the bytes that the ids decode to, without a second pass.
    Null and empty texts have no ids.  Columns called ids, n_tokens, spans or decoded
    are replaced if made; all others, and repeated rows, pass as they are.  Texts of any length
    are encoded whole; nothing is shuffled.
    """
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if offsets:
        fields.append(T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))))
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    kept, names, schema = _schema(df, fields)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                yield batch.slice(lo, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dec = encoder(path, pattern), decoder(path) if offsets or decoded else None
        for batch in parts(batches):
            for lo, hi, ids, n in enc.column(batch.column(column)):
                ends = np.cumsum(n)
                at = np.concatenate([[0], ends]) * 4
                arrays = [pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary()), pa.array(n, pa.int64())]
                if offsets:
                    spans = []
                    for i, e in zip(n.tolist(), ends.tolist(), strict=True):
                        first, last = character_spans(dec.raw(ids[e - i : e]), dec.length[ids[e - i : e]])
                        spans.append([list(x) for x in zip(first.tolist(), last.tolist(), strict=True)])
                    arrays.append(pa.array(spans, pa.list_(pa.list_(pa.int32()))))
                if decoded:
                    arrays.append(pa.array([dec.raw(ids[e - i : e]) for i, e in zip(n.tolist(), ends.tolist(), strict=True)], pa.binary()))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + arrays, names=kept + names)
        release()

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Add `decoded`, the bytes of the ids.

    Bytes, not text: ids that end inside a character have no text of their own, and
    joined bytes of neighbours do.  Null ids decode to no bytes.  An id outside the
    vocabulary is an error.
    """

    kept, names, schema = _schema(df, [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = decoder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                raw = [dec.raw(np.frombuffer(i or b"", "<u4")) for i in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(raw, pa.binary())], names=kept + names)

    return df.mapInArrow(run, schema)


def as_array(ids: str = "ids"):
    """Ids as array<int>, for consumers that want a list column."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def convert(column):
        return column.map(lambda b: None if b is None else np.frombuffer(b, "<u4").astype(np.int32))

    return convert(F.col(ids))
