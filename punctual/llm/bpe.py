"""BPE encoding and decoding with a public tokenizer, joined as a tree of halves."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import extended, fresh, slices, utf8

LEAF = 256  # symbols of an unsplit text that are encoded at once
WINDOW = 8  # tokens on each side of a join to begin with
KNOWN = 100_000  # items a worker remembers, and as many older ones
KNOWN_CHARS = 64  # longer ones aren't remembered
SLICE_BYTES = 2 << 20


#: How the tokenizer splits lower-case ASCII text; each match is encoded alone.
_ASCII = re.compile(rb"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-zA-Z0-9]+")


class Codec:
    """One tokenizer file, for texts of any length.

    White space never is part of a token, so what stands between blanks can be encoded
    alone; in ASCII text so can each piece of the pre-tokenizer. Items are encoded once for
    all texts of a call, and frequent ones are remembered from call to call. What the
    pre-tokenizer leaves unsplit and is longer than ``LEAF`` symbols is cut into halves
    until they are short; leaves are encoded alone and joined from the bottom up.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer, models

        with open(path, "rb") as f:
            config = json.load(f)
        self.whole = Tokenizer.from_str(json.dumps(config | {"truncation": None, "padding": None}))
        model = config["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model.get("end_of_word_suffix")
        self.pieces = partial(models.BPE, vocab=model["vocab"], merges=merges)
        self.suffix = suffix or ""
        special = [t["content"] for t in config.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.marks = [x.encode() for x in special]
        size = self.whole.get_vocab_size()
        self.tokens = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.ends = np.array([bool(suffix) and t.endswith(suffix) for t in self.tokens])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _items(self, text: bytes | None) -> list[bytes]:
        text = text or b""
        if not text.isascii() or any(m in text for m in self.marks):
            return text.split()
        return _ASCII.findall(text.lower())

    def encode_all(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        lists = list(map(self._items, texts))
        items = [x for part in lists for x in part]
        number = {x: i for i, x in enumerate(dict.fromkeys(items))}
        found = self._encoded(list(number))
        flat = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        which = np.fromiter(map(number.__getitem__, items), np.int64, len(items))
        counts = sizes[which]
        ends = np.cumsum(counts)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        at += np.repeat(starts[which] - (ends - counts), counts)
        ends = np.append(0, ends)
        bounds = np.cumsum([0, *map(len, lists)])
        return flat[at], np.diff(ends[bounds])

    def encode(self, text: bytes | None) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def _encoded(self, items: list[bytes]) -> list[bytes]:
        """The ids of each item as bytes; new ones are encoded, and remembered if short."""
        known, older, new = self.known, self.older, {}
        for x in items:
            if x not in known:
                new[x] = older.get(x)
        todo = [x for x, ids in new.items() if ids is None]
        single = [x for x in todo if len(x) <= LEAF and x.isascii() and _ASCII.fullmatch(x)]
        if single and self.suffix:
            # each is one word, whose last token has the mark
            text = b" ".join(single).decode()
            ids = self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.int32)
            bounds = np.flatnonzero(self.ends[ids]) + 1
            parts = np.split(ids, bounds[:-1])
            new.update((x, i.tobytes()) for x, i in zip(single, parts, strict=True))
        rest = [x for x in todo if new[x] is None]
        short = [x for x in rest if len(x) <= LEAF]
        done = self.whole.encode_batch_fast([x.decode() for x in short], add_special_tokens=False)
        new.update((x, np.array(e.ids, np.int32).tobytes()) for x, e in zip(short, done, strict=True))
        for x in rest:
            if len(x) > LEAF:
                new[x] = np.array(self._long(x.decode()), np.int32).tobytes()
        out = [new[x] if x in new else known[x] for x in items]
        known.update((x, ids) for x, ids in new.items() if len(x) <= KNOWN_CHARS)
        if len(known) > KNOWN:
            # what is asked for again comes back from the older half
            self.known, self.older = {}, known
        return out

    def decode_all(self, ids: pa.ListArray) -> list | pa.Array:
        """The texts of lists of ids, special tokens included; empty for null."""
        if self.whole.decoder is None:
            # without a decoder, tokens are joined with blanks
            parts = pa.array(self.tokens, pa.string()).take(ids.flatten())
            counts = pc.fill_null(pc.list_value_length(ids), 0)
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
            return pc.binary_join(pa.ListArray.from_arrays(offsets, parts), " ")
        return pa.array(
            [self.whole.decode(x or [], skip_special_tokens=False) for x in ids.to_pylist()],
            pa.string(),
        )

    def _long(self, word: str) -> list[int]:
        """A run without blanks: special tokens apart, the rest by its unsplit texts."""
        out: list[int] = []
        at = 0
        for m in self.special.finditer(word) if self.special else ():
            out += self._plain(word[at : m.start()])
            out.append(self.whole.token_to_id(m.group()))
            at = m.end()
        return out + self._plain(word[at:])

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        if self.whole.normalizer:
            text = self.whole.normalizer.normalize_str(text)
        pieces = self.whole.pre_tokenizer.pre_tokenize_str(text)
        return [i for piece, _ in pieces for i in self.join_tree(piece)]

    @cached_property
    def inner(self):
        """The merges for a piece within a word, which has no end-of-word mark."""
        return self.pieces()

    @cached_property
    def last(self):
        return self.pieces(end_of_word_suffix=self.suffix) if self.suffix else self.inner

    def _model(self, symbols: str, last: bool) -> list[int]:
        return [t.id for t in (self.last if last else self.inner).tokenize(symbols)]

    def join_tree(self, symbols: str) -> list[int]:
        """The ids of an unsplit text: halves are encoded, then joined pair by pair."""
        count = -(-len(symbols) // LEAF)
        if count <= 1:
            return self._model(symbols, True)
        size = -(-len(symbols) // count)
        cuts = [symbols[i : i + size] for i in range(0, len(symbols), size)]
        level = [self._model(c, k == len(cuts) - 1) for k, c in enumerate(cuts)]
        while len(level) > 1:
            pairs = [
                self._join(level[k], level[k + 1], k + 2 == len(level))
                for k in range(0, len(level) - 1, 2)
            ]
            level = pairs + ([level[-1]] if len(level) % 2 else [])
        return level[0]

    def _symbols(self, ids: list[int], ends: bool) -> str:
        text = "".join(map(self.whole.id_to_token, ids))
        return text[: -len(self.suffix)] if ends and self.suffix else text

    def _join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Re-encode a window around the join until both sides agree with it.

        They agree where the window's first and last tokens are those that the sides have
        there: then each two neighbours in the result are neighbours in one exact encoding,
        which makes the whole the exact encoding. A window that reaches an end of a side
        needs no agreement there.
        """
        n = WINDOW
        while True:
            a, b = max(0, len(left) - n), min(len(right), n)
            ends = last and b == len(right)
            middle = self._model(self._symbols(left[a:] + right[:b], ends), ends)
            agree_left = a == 0 or middle[0] == left[a]
            agree_right = b == len(right) or middle[-1] == right[b - 1]
            if agree_left and agree_right:
                return left[:a] + middle + right[b:]
            n *= 2


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``docs`` plus the token ids of the text, as the tokenizer's library gives them
    without added special tokens, truncation and padding.

    ``path`` is the tokenizer file, which is on every executor at the same place. Files must
    split and lower-case as ``word_bpe_49k.json`` does (``_ASCII`` states its rules for ASCII
    text); for other rules, such as bytes with blanks in tokens, the ids are wrong. A null or
    empty text has no ids. Each row is encoded alone, so repeated rows get equal ids. A
    column named like the result is replaced, all other columns are kept.
    """
    docs = fresh(docs, ids_col)
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    run = partial(_encode, at=at, path=path, name=ids_col)
    return docs.mapInArrow(run, extended(docs.schema, f"`{ids_col}` array<int>"))


def decode(
    docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded"
) -> DataFrame:
    """``docs`` plus the text of the token ids, special tokens included; none for null ids."""
    docs = fresh(docs, text_col)
    at = [c.lower() for c in docs.columns].index(ids_col.lower())
    run = partial(_decode, at=at, path=path, name=text_col)
    return docs.mapInArrow(run, extended(docs.schema, f"`{text_col}` string"))


def _encode(batches: Iterator[pa.RecordBatch], at: int, path: str, name: str):
    for batch in batches:
        sizes = [len(t or b"") for t in utf8(batch.column(at))]
        for part in slices(batch, sizes, SLICE_BYTES):
            ids, counts = codec(path).encode_all(utf8(part.column(at)))
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
            yield _with(part, pa.ListArray.from_arrays(offsets, pa.array(ids)), name)


def _decode(batches: Iterator[pa.RecordBatch], at: int, path: str, name: str):
    for batch in batches:
        counts = pc.fill_null(pc.list_value_length(batch.column(at)), 0)
        for part in slices(batch, (4 * counts.to_numpy()).tolist(), SLICE_BYTES):
            yield _with(part, codec(path).decode_all(part.column(at)), name)


def _with(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def encode_decode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` and ``decoded``, the text of these ids, in one pass.

    The same as ``decode`` after ``encode``, without a second Python worker for each task
    and without moving the ids between the two.
    """
    docs = fresh(docs, "ids", "decoded")
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    run = partial(_encode_decode, at=at, path=path)
    return docs.mapInArrow(run, extended(docs.schema, "ids array<int>, decoded string"))


def _encode_decode(batches: Iterator[pa.RecordBatch], at: int, path: str):
    for part in _encode(batches, at, path, "ids"):
        yield _with(part, codec(path).decode_all(part.column(part.num_columns - 1)), "decoded")


def digests(done: DataFrame) -> list:
    """Columns that sum up ``ids`` and ``decoded``."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]


def tokenizer_path() -> str:
    """Where the driver's installation has the tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's row per document."""
    done = encode_decode(docs.select("doc_id", "text"), path or tokenizer_path()).drop("text")
    return done.select("doc_id", *digests(done))
