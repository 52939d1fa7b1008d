"""Packing documents into sequences of a fixed length by bounded-space online best fit.

Documents become token pieces; only those longer than a sequence are cut. Pieces are dealt
to shards, and each shard packs the pieces as they come: a fixed number of bins is open,
a bitset over free space finds the tightest one that still takes the piece, and when a new
bin would be one too many, the fullest is closed. A shard holds its open bins and no more.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditloom.llm.common import give_back, kept_in_worker, slices, small_batches, text_of
from creditloom.sources.staging import stage

LENGTH = 2048
END_ID = 0
OPEN_BINS = 1024
SHARD_PIECES = 500_000
"""Pieces that one shard packs, about; each shard may waste a few sequences at its end."""
WORD_CACHE = 300_000
"""Words whose ids a worker surely remembers; it forgets those that were not met for longer."""


#: Fixed values of the vocabulary's pre-tokenizer, for lower-case text below U+0180: what
#: its classes of letters, numbers and white space hold there. A match is one word.
LATIN_WORD = re.compile(
    "[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+"
    "|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
    "|'s|'t|'re|'ve|'m|'ll|'d"
    "|[^\t-\r \u0085\u00a0a-z0-9\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be"
    "\u00df-\u00f6\u00f8-\u017f]+"
)
ASCII_WORD = re.compile("[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\t-\r a-z0-9]+")
OTHER = re.compile("[\x1c-\x1f\u0130\u0180-\U0010ffff]|<[|]")
"""White space to Python and not to the tokenizer; what is no Latin; special tokens."""
ASCII_OTHER = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
"""What of OTHER an ASCII text can hold."""
CHUNK = re.compile("[^ \t\n\r]+")
WORD_END = "</w>"
"""Ends the last token of each word, and no other."""


class Recent:
    """A mapping that forgets what was not asked for since two times ``limit`` new entries."""

    def __init__(self, limit: int):
        self.limit, self.now, self.before = limit, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that must be learned; the others are in ``now`` after it."""
        new = keys.difference(self.now)
        again = [key for key in new if key in self.before]
        self.now.update(zip(again, map(self.before.__getitem__, again)))
        return new.difference(again)

    def age(self) -> None:
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    The tokenizer works word by word and words repeat, so the ids of each are asked for
    once. Latin texts are lower-cased first and cut into words by the tokenizer's own rule.
    Other texts, and what may hold a special token, are cut at white space, which the tokenizer
    never joins across; chunks that are no Latin are left to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.chunks, self.known = Recent(WORD_CACHE), Recent(WORD_CACHE)

    def encode(self, texts: list[str]) -> list[bytes]:
        latin = [_is_latin(text) for text in texts]
        split = [_words(t) if plain else CHUNK.findall(t) for t, plain in zip(texts, latin)]
        new = self.chunks.missing(set().union(*[own for own, p in zip(split, latin) if not p]))
        words = {chunk: _words(chunk) for chunk in new if _is_latin(chunk)}
        self._learn([[chunk] for chunk in new if chunk not in words], self.chunks.now)
        met = set().union(*[own for own, p in zip(split, latin) if p], *words.values())
        self._know(self.known.missing(met))
        ids_of_word, ids_of_chunk = self.known.now.__getitem__, self.chunks.now.__getitem__
        for chunk, inside in words.items():
            self.chunks.now[chunk] = b"".join(map(ids_of_word, inside))
        out = [
            b"".join(map(ids_of_word if plain else ids_of_chunk, own))
            for own, plain in zip(split, latin)
        ]
        self.chunks.age()
        self.known.age()
        return out

    def _know(self, new: set[str]) -> None:
        words = list(new)
        groups = [words[i : i + 500] for i in range(0, len(words), 500)]
        self._learn(groups, self.known.now)

    def _learn(self, groups: list[list[str]], into: dict[str, bytes]) -> None:
        """Ask for the ids of words: several at once where the tokenizer sees each as one."""
        for at in range(0, len(groups), 20):
            asked = groups[at : at + 20]
            joined = [" ".join(group) for group in asked]
            encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            for group, got in zip(asked, encoded):
                ids = np.array(got.ids, "<u4")
                ends = [4 * len(ids)]
                if len(group) > 1:
                    ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
                    if len(ends) != len(group):  # a control character that counts as white space
                        self._learn([[word] for word in group], into)
                        continue
                ids = ids.tobytes()
                for word, start, end in zip(group, [0, *ends], ends):
                    into[word] = ids[start:end]


def _is_latin(text: str) -> bool:
    if text.isascii():  # searching for a few characters is quicker than a pattern
        return not any(mark in text for mark in ASCII_OTHER)
    return OTHER.search(text) is None


def _words(latin: str) -> list[str]:
    latin = latin.lower()
    return (ASCII_WORD if latin.isascii() else LATIN_WORD).findall(latin)


def pieces(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Token pieces: ``doc_id``, ``row``, ``piece``, ``start``, ``length``, ``ids`` (binary).

    ``ids`` are little-endian unsigned 32-bit; a document's ids end with ``end_id``, so an
    empty or null text gives that alone. ``row`` tells rows apart that repeat an identifier.
    """
    schema = "doc_id long, row long, piece int, start long, length long, ids binary"
    target = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("row", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
        ]
    )
    last = end_id.to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        for batch in slices(batches, "text"):
            ids = [own + last for own in encoder.encode(batch["text"].to_pylist())]
            sizes = np.array([len(own) // 4 for own in ids], np.int64)
            counts = -(-sizes // length)
            owner = np.repeat(np.arange(len(ids)), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * length
            cut_ids = [
                ids[i] if n == 1 else ids[i][4 * at : 4 * (at + length)]
                for i, at, n in zip(owner.tolist(), start.tolist(), counts[owner].tolist())
            ]
            own = pa.array(owner)
            columns = [batch["doc_id"].take(own), batch["row"].take(own)]
            for values in (piece, start, np.minimum(length, sizes[owner] - start), cut_ids):
                columns.append(pa.array(values, target[len(columns)].type))
            yield pa.RecordBatch.from_arrays(columns, schema=target)
        give_back()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_of("text").alias("text"),
    )
    return rows.mapInArrow(cut, schema)


class Bins:
    """Open bins by free space. A bit of ``mask`` is set where a bin with that space is open."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit = length, limit
        self.mask = self.open = 0
        self.at: list[deque] = [deque() for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        bins = self.at[free]
        found = bins.popleft()
        if not bins:
            self.mask &= ~(1 << free)
        self.open -= 1
        return found

    def put(self, size: int, fresh: int) -> tuple[int, int]:
        """Bin and offset for a piece; ``fresh`` is the number a new bin would get."""
        fits = self.mask >> size
        if fits:
            free = size + ((fits & -fits).bit_length() - 1)
            found = self._take(free)
        else:
            free, found = self.length, fresh
        left = free - size
        if left:
            self.at[left].append(found)
            self.mask |= 1 << left
            self.open += 1
            if self.open > self.limit:  # the fullest closes
                self._take((self.mask & -self.mask).bit_length() - 1)
        return found, self.length - free


def pack(
    parts: DataFrame, length: int = LENGTH, bins: int = OPEN_BINS, per_shard: int = SHARD_PIECES
) -> DataFrame:
    """Place staged pieces: the same columns plus ``sequence_id`` and ``offset``.

    Every piece has a ``doc_id``, ``row``, ``piece`` and ``length`` of 1 to ``length``; other
    columns travel along. Shards are a hash of the piece's name, so each sees pieces of all
    sizes in an order without pattern, and a rerun packs alike. ``sequence_id`` is the shard
    and a running number.
    """
    shards = max(1, -(-parts.count() // per_shard))
    spread = F.xxhash64("doc_id", "row", "piece")
    dealt = (
        parts.withColumn("_spread", spread)
        .withColumn("_shard", F.pmod("_spread", F.lit(shards)).cast("int"))
        .repartition(shards, "_shard")
        .sortWithinPartitions("_shard", "_spread", "row", "piece")
        .drop("_spread")
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema]
        + ["sequence_id long", "offset long"]
    )
    names = parts.columns

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, open_bins, fresh = None, None, 0
        for batch in batches:
            sequences, offsets = [], []
            for own, size in zip(batch["_shard"].to_pylist(), batch["length"].to_pylist()):
                if own != shard:
                    shard, open_bins, fresh = own, Bins(length, bins), own << 40
                found, offset = open_bins.put(size, fresh)
                fresh += found == fresh
                sequences.append(found)
                offsets.append(offset)
            arrays = [batch[c] for c in names]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    return dealt.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ``ids`` to one row per sequence: its ids in order, and its length."""
    piece = F.struct("offset", "ids", "length")
    joined = F.transform(F.sort_array(F.collect_list(piece)), lambda p: F.hex(p["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.array_join(joined, "")).alias("ids"), F.sum("length").alias("length")
    )


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Where each piece of each document goes, and the checksum of its ids.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``. Null and empty texts are one end token. Rows that repeat an identifier are
    packed each for itself; other columns are ignored.
    """
    cut = pieces(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    with small_batches(docs.sparkSession):
        thin = stage(cut, "pieces")
    return pack(thin).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
