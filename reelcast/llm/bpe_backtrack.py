"""BPE encoding and decoding with public byte-level vocabularies, without replaying merges.

Encoder (per pre-token, linear time): an Aho-Corasick automaton over all token byte strings gives the longest token
at each position.  Tokens are taken longest first; a token is accepted only when it is *compatible* with the token
before it, i.e. when merging the two byte strings together by the vocabulary's merge order leaves exactly these two
tokens.  A sequence whose neighbours are all compatible is the one that merging gives.  Where no shorter token fits
either, the encoder steps back one token and marks the position as a dead end, so each position is left at most once.
Compatibility of a pair is found by unwinding both tokens along the shared border and kept in a table.

Decoder: one blob of all token bytes with an offset table; the ids of a whole batch are expanded by one gather.

Both run in Arrow batches; the vocabulary file's path is a parameter, read by each task's worker.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import kept, lean, small_batches

# the pre-tokeniser pattern of the byte-level vocabularies (fixed value, public GPT-2 pattern)
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# bytes that a worker's tables of pieces and of token pairs may take, each, and that of pre-tokens; a table starts anew
# beyond it (caches: results do not change).  An entry counts as its characters, its ids and a fixed overhead.
TABLE_BYTES, WORD_BYTES = 24 << 20, 44 << 20
ENTRY_BYTES = 160
SLICE_CHARS = 1 << 18


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _gather(blob: np.ndarray, table: np.ndarray, ids: np.ndarray, offsets: np.ndarray,
            used: np.ndarray | None = None) -> list[bytes]:
    """The blob's parts that ``ids`` name, joined for every run of ids."""
    starts = table[ids]
    n = table[ids + 1] - starts
    if used is not None:
        n = np.where(used, n, 0)
    ends = np.concatenate([[0], np.cumsum(n)])
    data = blob[np.repeat(starts - ends[:-1], n) + np.arange(int(ends[-1]))].tobytes()
    border = ends[offsets]
    return [data[border[i]:border[i + 1]] for i in range(len(offsets) - 1)]


class TokenBytes:
    """The bytes of every token of one tokenizer file, with an offset table: all that decoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self._load(json.load(f))

    def _load(self, spec: dict) -> None:
        letters = _byte_letters()
        self.raw = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, number in vocab.items():
            self.bytes[number] = token.encode() if token in self.special else self.raw(token)
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        lengths = np.fromiter(map(len, self.bytes), np.int64, size)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.written: tuple[np.ndarray, np.ndarray] | None = None

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Text of every run of ids; bytes that are no UTF-8 become U+FFFD.  Null ids and ids outside the
        vocabulary count as nothing."""
        bad = (ids < 0) | (ids >= len(self.offsets) - 1)
        runs = _gather(self.blob, self.offsets, np.where(bad, 0, ids), offsets, ~bad)
        return [x.decode("utf-8", "replace") for x in runs]

    def numbers(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Decimal ids of every run, joined by commas."""
        if self.written is None:
            texts = [b"%d," % i for i in range(len(self.bytes))]
            self.written = (np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, texts)))]))
        return [x[:-1] for x in _gather(*self.written, ids, offsets)]


class Vocabulary(TokenBytes):
    """Token bytes and what encoding needs: merge orders, the automaton, shorter tokens, the pair table."""

    def _load(self, spec: dict) -> None:
        import ahocorasick
        super()._load(spec)
        vocab = spec["model"]["vocab"]
        self.of_bytes = {self.raw(t): i for t, i in vocab.items() if t not in self.special}
        # merge rank by pair; the pair that makes each token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for order, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = (vocab[a], vocab[b])
            self.rank[pair] = order
            self.parts.setdefault(vocab[a + b], pair)
        self.of_text = {token.decode("latin-1"): number for token, number in self.of_bytes.items()}
        self.automaton = ahocorasick.Automaton()
        for token, number in self.of_text.items():
            self.automaton.add_word(token, (len(token) - 1, number))
        self.automaton.make_automaton()
        self.size = list(map(len, self.bytes))
        self.shorter: dict[int, int] = {}       # longest proper prefix that is a token
        for token, number in self.of_bytes.items():
            self.shorter[number] = next((self.of_bytes[token[:k]] for k in range(len(token) - 1, 0, -1)
                                         if token[:k] in self.of_bytes), -1)
        self.pairs: dict[int, bool] = {}

    def _formed(self, token: int) -> int:
        """Order in which the token is formed (-1: a single byte)."""
        pair = self.parts.get(token)
        return -1 if pair is None else self.rank[pair]

    def compatible(self, left: int, right: int) -> bool:
        """Merging the joined bytes of both tokens keeps the border between them."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) * ENTRY_BYTES > TABLE_BYTES:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """Unwind both tokens in reverse merge order.  At each moment of the merging, the two pieces that touch the
        border are a suffix part of ``left`` and a prefix part of ``right``; the border breaks if those pieces merge
        before either of them is merged further into its own token."""
        a, b = left, right
        until_a = until_b = len(self.rank)       # order at which the piece is merged into its parent
        while True:
            joined = self.rank.get((a, b))
            # equal pairs are merged from the left: a tie with the left piece's merge keeps the border, a tie with
            # the right piece's merge breaks it
            if joined is not None and joined < until_a and joined <= until_b:
                return False
            fa, fb = self._formed(a), self._formed(b)
            if fa < 0 and fb < 0:
                return True
            if fa > fb or (fa == fb and fa >= 0):
                until_a, a = fa, self.parts[a][1]
            else:
                until_b, b = fb, self.parts[b][0]

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        word = word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.of_text.get(word)
        if whole is not None:
            return [whole]
        # matches come by their end, so the last one kept for a start is the longest
        longest = {end - back: number for end, (back, number) in self.automaton.iter(word)}
        n, pairs, size = len(word), self.pairs, self.size
        dead: set[int] = set()
        out: list[int] = []
        pos, token, last = 0, longest[0], -1
        while True:
            end = pos + size[token]
            if end not in dead:
                fits = last < 0 or pairs.get(last << 20 | token)
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    pos, last, token = end, token, longest[end]
                    continue
            shorter = self.shorter[token]
            if shorter >= 0:
                token = shorter
                continue
            dead.add(pos)                        # nothing fits from here: step back
            token = out.pop()
            pos -= size[token]
            last = out[-1] if out else -1


OPERATOR = "bpe"


def _loaded(kind: type, path: str):
    """One object of a kind and file in each worker, until another operator's task takes it over."""
    loaded = kept(OPERATOR)
    if (kind, path) not in loaded:
        loaded[kind, path] = kind(path)
    return loaded[kind, path]


class Encoder:
    """Pre-tokenises texts and keeps the ids of the pieces seen by this worker.

    A text without neighbouring white space has a border of pre-tokens before every space and on both sides of every
    line end, so it is cut there first; only pieces not seen before go through the pattern.  Other texts go through
    it whole, and nothing but their pre-tokens is kept."""

    def __init__(self, path: str):
        import regex
        self.vocabulary = Vocabulary(path)
        self.find = regex.compile(PRETOKENS).findall
        self.spaced = regex.compile(r"\s\s|\s\Z").search
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words: dict[str, list[int]] = {}
        self.word_bytes = 0
        self.reset()

    def reset(self) -> None:
        self.flat, self.ends, self.piece_bytes = array("i"), array("q", [0]), 0
        encoder = self

        class Table(dict):
            """Number of every piece; one that doesn't start with a line end stands after a space."""

            def __missing__(self, piece):
                self[piece] = number = encoder._add(piece if piece[:1] == "\n" else " " + piece)
                encoder.piece_bytes += ENTRY_BYTES + len(piece)
                return number

        self.table = Table()

    def _add(self, text: str) -> int:
        """Append the ids of a piece; its number."""
        bare = text[1:]
        if bare.isalpha() and text[0] == " " and (text.isascii() or max(text) < "\u0180"):
            found = (text,)                      # one run of letters: the pattern would take it whole
        else:
            found = self.find(text)
        for word in found:
            ids = self.words.get(word)
            if ids is None:
                ids = self.vocabulary.encode(word)
                if len(ids) < 64:
                    if self.word_bytes > WORD_BYTES:
                        self.words.clear()
                        self.word_bytes = 0
                    self.words[word] = ids
                    self.word_bytes += ENTRY_BYTES + len(word) + 8 * len(ids)
            self.flat.extend(ids)
        self.ends.append(len(self.flat))
        return len(self.ends) - 2

    def _is_plain(self, text: str) -> bool:
        return not (self.spaced(text) or self.special is not None and any(s in text for s in self.vocabulary.special))

    def _plain(self, text: str) -> np.ndarray:
        """Numbers of the text's pieces."""
        pieces = text.replace("\n", " \n").split(" ")
        out = np.empty(len(pieces), np.int64)
        out[0] = self._add(pieces[0])
        out[1:] = np.fromiter(map(self.table.__getitem__, pieces[1:]), np.int64, len(pieces) - 1)
        return out

    def _whole(self, text: str) -> np.ndarray:
        """Numbers of the parts between special strings; a special string is marked as below zero."""
        parts = self.special.split(text) if self.special is not None else [text]
        return np.asarray([-1 - self.vocabulary.special[part] if i % 2 else self._add(part)
                           for i, part in enumerate(parts)], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of all texts, and offsets by text."""
        if self.piece_bytes + 4 * len(self.flat) + 8 * len(self.ends) > TABLE_BYTES:
            self.reset()
        plain = [self._is_plain(text) for text in texts]
        first = [self._plain(text) if p else None for text, p in zip(texts, plain)]
        kept, kept_ends = len(self.flat), len(self.ends)
        numbers = [self._whole(text) if n is None else n for text, n in zip(texts, first)]
        try:
            return self._ids(numbers)
        finally:                                 # what only these texts need goes again
            del self.flat[kept:]
            del self.ends[kept_ends:]

    def _ids(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not numbers:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        counts = np.fromiter(map(len, numbers), np.int64, len(numbers))
        pieces = np.concatenate(numbers)
        bounds = np.array(self.ends, np.int64)
        flat = np.array(self.flat, np.int32)
        at = np.maximum(pieces, 0)
        starts = bounds[at]
        n = np.where(pieces < 0, 1, bounds[at + 1] - starts)
        ends = np.cumsum(n)
        index = np.repeat(starts - (ends - n), n) + np.arange(int(ends[-1]))
        if (pieces < 0).any():
            ids = np.append(flat, 0)[np.minimum(index, len(flat))].astype(np.int32)
            ids[(ends - n)[pieces < 0]] = -1 - pieces[pieces < 0]
        else:
            ids = flat[index]
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield lo, min(hi, n)
        lo = min(hi, n)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row, as the tokenizers library encodes without adding special tokens; special
    strings that stand in a text become their ids.  Null or empty text: an empty list; repeated rows stay; extra
    columns are not read; an empty table gives an empty result."""
    path = vocabulary or default_vocabulary()
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _loaded(Encoder, path)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for lo, hi in _slices(sizes, SLICE_CHARS):
                ids, offsets = encoder.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=["id", "ids"])

    return small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None,
           name: str = "decoded") -> DataFrame:
    """(id, ids, decoded text) of every row, special tokens kept.  A null or empty list decodes to an empty text; null
    ids and ids outside the vocabulary decode to nothing."""
    path = vocabulary or default_vocabulary()
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _loaded(TokenBytes, path)
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], lists.type)
            sizes = np.diff(np.asarray(lists.offsets, np.int64))
            for lo, hi in _slices(sizes, SLICE_CHARS // 4):
                part = lists.slice(lo, hi - lo)
                offsets = np.asarray(part.offsets, np.int64)
                flat = part.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).fill_null(-1)
                texts = table.decode(np.asarray(flat, np.int64), offsets - offsets[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), part,
                                                  pa.array(texts, pa.string())], names=["id", "ids", "decoded"])

    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"id {kind}, ids array<int>, decoded string").withColumnsRenamed({"id": id_col, "decoded": name})


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, decoded again and reduced to digests in one
    pass of one worker a core.  Rows as in :func:`encode`."""
    path = vocabulary or default_vocabulary()
    kind = dict(df.dtypes)[id_col]
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _loaded(Encoder, path)
        table = encoder.vocabulary
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for lo, hi in _slices(sizes, SLICE_CHARS):
                ids, offsets = encoder.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)),
                     pa.array([sha(x) for x in table.numbers(ids, offsets)], pa.string()),
                     pa.array([sha(x.encode()) for x in table.decode(ids, offsets)], pa.string())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lean(run, OPERATOR), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op6_bpe_backtracking(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
