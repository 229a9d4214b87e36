"""BPE by a table of distinct words: encode each once, join the ids back by position."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import keep

# Characters of text whose words are numbered together, one text at least.
CHUNK_CHARS = 64_000_000

# Fixed value: how byte-level BPE splits a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
# Here the two libraries' Unicode tables agree on letters, numbers and white space.
_AGREED = re.compile("[\x00-՗₠-ꟍ]*")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=2)
def _specials(path: str):
    """A pattern for the tokens that are found before a text is split, or None."""
    names = sorted((t.content for t in _tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def split_words(text: str, path: str) -> list[str]:
    """The words of a text as the tokenizer splits it; joined they are the text."""
    special = _specials(path)
    pieces = special.split(text) if special else [text]
    words = []
    for k, piece in enumerate(pieces):
        if k % 2:
            words.append(piece)
        elif _AGREED.fullmatch(piece):
            words += _SPLIT.findall(piece)
        else:
            words += [piece[a:b] for _, (a, b) in _tokenizer(path).pre_tokenizer.pre_tokenize_str(piece)]
    return words


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress(data)


# Numbers packed at a time.
_RUN = 1 << 20


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Integers from 0 on as one byte each, of 128 and above with open bits to follow.

    The byte is the number itself, or its length in bits and the two bits after the
    first. Small numbers are frequent, so the bytes compress; the open bits are
    stored as they are, numbers of one length together.
    """
    pack = zstandard.ZstdCompressor(level=9).compressobj()
    out = []
    for at in range(0, len(numbers), _RUN):
        run = np.asarray(numbers[at : at + _RUN], np.int64)
        bits = np.frexp(run)[1].astype(np.int64)
        left = np.where(bits > 7, bits - 3, 0)
        first = np.where(bits > 7, 128 + 4 * (bits - 8) + (run >> left & 3), run).astype(np.uint8)
        out += [pack.compress(np.array([len(run)], "<u4").tobytes() + first.tobytes())]
        out += [pack.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)]
        for n in np.flatnonzero(np.bincount(left)[1:]) + 1:
            low = run[left == n][:, None] >> np.arange(n) & 1
            out.append(pack.compress(np.packbits(low.astype(np.uint8)).tobytes()))
        out.append(pack.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK))
    return b"".join([*out, pack.flush()])


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _unpack_numbers(data: bytes) -> np.ndarray:
    read, at, runs = np.frombuffer(_unpack(data), np.uint8), 0, [np.empty(0, np.int32)]
    while at < len(read):
        size = int.from_bytes(read[at : at + 4].tobytes(), "little")
        first = read[at + 4 : at + 4 + size].astype(np.int32)
        at += 4 + size
        left = np.where(first > 127, (first - 128) // 4 + 5, 0)
        run = np.where(first > 127, (4 + first % 4) << left, first)
        for n in np.flatnonzero(np.bincount(left)[1:]) + 1:
            here = np.flatnonzero(left == n)
            end = at + -(-here.size * n // 8)
            low = np.unpackbits(read[at:end], count=here.size * n).reshape(-1, n)
            run[here] |= low.astype(np.int32) @ (1 << np.arange(n, dtype=np.int32))
            at = end
        runs.append(run.astype(np.int32))
    return np.concatenate(runs)


# A chunk is one row with its documents (bucket NULL) and one row for each bucket of its words.
_CHUNK = "chunk string, bucket int, numbers binary, letters binary, ids array<long>, sizes array<long>"
_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
# Words of a chunk that are numbered by frequency; small numbers pack well.
_FREQUENT = 32_768


def _number_words(path: str, chunk_chars: int, buckets: int):
    """Documents to chunks: every word becomes the number of its distinct word.

    The distinct words are ordered by bucket (crc32 of the word) and spelling.
    The most frequent ones have the first numbers, their places in that order
    going along; all others follow in that order.
    """

    def rows(ids, sizes, numbers, vocabulary):
        chunk = uuid.uuid4().hex
        words = [w.encode("utf-8", "surrogatepass") for w in vocabulary]
        # What is no longer needed goes at once: a chunk is the most that a task holds.
        vocabulary.clear()
        home = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
        by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        order = by_word[np.argsort(home[by_word], kind="stable")]
        seen = np.concatenate(numbers)
        numbers.clear()
        times = np.bincount(seen, minlength=len(words))[order]
        frequent = np.argsort(-times, kind="stable")[:_FREQUENT]
        rest = np.ones(len(words), bool)
        rest[frequent] = False
        number = np.empty(len(words), np.int32)
        number[order[np.r_[frequent, np.flatnonzero(rest)]]] = np.arange(len(words), dtype=np.int32)
        seen = number[seen]
        made = [(chunk, None, _pack_numbers(seen), _pack_numbers(frequent), ids, sizes)]
        ends = np.searchsorted(home[order], np.arange(buckets + 1))
        for bucket in range(buckets):
            here = [words[i] for i in order[ends[bucket] : ends[bucket + 1]]]
            if here:
                lengths = np.fromiter(map(len, here), np.int32, len(here))
                made.append((chunk, bucket, _pack_numbers(lengths), _pack(b"".join(here)), None, None))
        arrays = [pa.array(v, t) for v, t in zip(zip(*made, strict=True), _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, _NAMES)

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids, sizes, numbers, vocabulary, chars = [], [], [], {}, 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                text = value.as_py() or ""
                words = split_words(text, path)
                for w in words:
                    if w not in vocabulary:
                        vocabulary[w] = len(vocabulary)
                numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                chars += len(text)
                if chars >= chunk_chars:
                    yield rows(ids, sizes, numbers, vocabulary)
                    ids, sizes, chars = [], [], 0
                    pa.default_memory_pool().release_unused()
        if ids:
            yield rows(ids, sizes, numbers, vocabulary)

    return run


_ENCODED = "chunk string, bucket int, counts binary, found binary"


def _encode_bucket(path: str):
    """All chunks' words of one bucket: each distinct word is encoded once."""

    def run(group: pa.Table) -> pa.Table:
        table: dict[bytes, int] = {}
        places = []
        for lengths, letters in zip(group["numbers"].to_pylist(), group["letters"].to_pylist(), strict=True):
            ends, data = np.r_[0, np.cumsum(_unpack_numbers(lengths))].tolist(), _unpack(letters)
            words = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            for w in words:
                if w not in table:
                    table[w] = len(table)
            places.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        distinct, ids = list(table), []
        for at in range(0, len(distinct), 10_000):
            words = [w.decode("utf-8", "surrogatepass") for w in distinct[at : at + 10_000]]
            ids += [e.ids for e in _tokenizer(path).encode_batch(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        counts = [_pack_numbers(sizes[p]) for p in places]
        found = [
            _pack_numbers(np.fromiter((i for n in p for i in ids[n]), np.int32, int(sizes[p].sum()))) for p in places
        ]
        columns = {"chunk": group["chunk"], "bucket": group["bucket"], "counts": counts, "found": found}
        return pa.table(columns).cast(pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("counts", pa.binary()), ("found", pa.binary())]))

    return run


_DONE = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _assemble(table):
    """One chunk's documents and the ids of its words, joined by the words' numbers."""

    def run(chunk: pa.Table, encoded: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [])
        answers = sorted(zip(*(encoded[c].to_pylist() for c in ("bucket", "counts", "found")), strict=True))
        counts = np.concatenate([_unpack_numbers(a[1]) for a in answers] or [np.empty(0, np.int32)]).astype(np.int64)
        found = np.concatenate([_unpack_numbers(a[2]) for a in answers] or [np.empty(0, np.int32)])
        # Decode: the id-to-piece join, once for each distinct word.
        piece, ids_of, text_of, at = table.value, [], [], 0
        for size in counts:
            spelt = found[at : at + size].tolist()
            at += size
            ids_of.append(",".join(map(str, spelt)))
            text_of.append(b"".join([piece[i] for i in spelt]))
        for numbers, letters, ids, sizes in zip(
            *(chunk[c].to_pylist() for c in ("numbers", "letters", "ids", "sizes")), strict=True
        ):
            frequent = _unpack_numbers(letters)
            rest = np.ones(len(counts), bool)
            rest[frequent] = False
            place = np.r_[frequent, np.flatnonzero(rest)].astype(np.int64)[_unpack_numbers(numbers)]
            at = 0
            for doc_id, size in zip(ids, sizes, strict=True):
                words = place[at : at + size]
                at += size
                listed = words.tolist()
                whole = b"".join([text_of[n] for n in listed]).decode("utf-8", "replace").encode()
                out[0].append(doc_id)
                out[1].append(int(counts[words].sum()))
                out[2].append(hashlib.sha256(",".join([ids_of[n] for n in listed]).encode()).hexdigest())
                out[3].append(hashlib.sha256(whole).hexdigest())
        pa.default_memory_pool().release_unused()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        names = [c.split()[0] for c in _DONE.split(", ")]
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names)

    return run


def pieces(path: str) -> list[tuple[int, bytearray]]:
    """(id, piece): the bytes that each id of the vocabulary stands for."""
    tok = _tokenizer(path)
    # Byte-level vocabularies write a byte as a character: itself if printable, else from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return [(i, bytearray(byte[c] for c in p)) for p, i in tok.get_vocab(with_added_tokens=True).items()]


def decode_ids(rows: DataFrame, key: str, path: str) -> DataFrame:
    """``(key, decoded)``: the bytes of each row's ``ids``, by a join with the id-to-piece table.

    The table has as many rows as the vocabulary, a bound that no data changes,
    and so is broadcast. ``key`` is unique; ids that the vocabulary does not have
    decode to nothing. Rows whose ``ids`` are NULL or empty are left out.
    """
    pieces_ = rows.sparkSession.createDataFrame(pieces(path), "id int, piece binary")
    placed = rows.select(key, F.posexplode("ids").alias("at", "id"))
    joined = placed.join(F.broadcast(pieces_), "id", "left")
    parts = F.array_sort(F.collect_list(F.struct("at", "piece")))
    joined = joined.groupBy(key).agg(parts.alias("parts"))
    text = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["piece"])), ""))
    return joined.select(key, text.alias("decoded"))


def encode_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, whole texts, NULL as empty.

    Tasks split texts into words and number them within chunks of ``chunk_chars``
    characters, so a frequent word is shuffled once a chunk. The distinct words of all
    chunks meet in buckets, one for each shuffle partition, where each is encoded
    once; the ids go back to the chunks in the words' order and are joined to
    the documents by number. Ids decode through the id-to-piece table, which is
    broadcast: as many entries as the vocabulary, whatever the data.

    Memory: a task holds one chunk, or the distinct words of one bucket; set
    spark.sql.shuffle.partitions so that these are some 10^5. A repeated row
    comes back as often as it came.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(doc_id).cast("long"), F.col(text))
    rows = keep(texts.mapInArrow(_number_words(path, chunk_chars, buckets), _CHUNK))
    words = rows.where("bucket IS NOT NULL").select("chunk", "bucket", "numbers", "letters")
    encoded = words.groupBy("bucket").applyInArrow(_encode_bucket(path), _ENCODED)
    chunks = rows.where("bucket IS NULL").select("chunk", "numbers", "letters", "ids", "sizes")
    table = spark.sparkContext.broadcast(dict((i, bytes(p)) for i, p in pieces(path)))
    both = chunks.groupBy("chunk").cogroup(encoded.groupBy("chunk"))
    return both.applyInArrow(_assemble(table), _DONE)
