"""Token ids in patched frame-of-reference blocks.

A token file set is a folder of Parquet files whose rows are segments, in ascending order of doc_id
over (part, segment):

    part, segment          place in the order
    start                  ids of the part before the segment
    doc_ids, doc_lens      the segment's documents and their numbers of ids
    block_starts           byte offset of each block in ``payload``
    payload                the blocks, one after the other

A block holds up to 128 ids: the least id (u32), the bit width (u8), the number of exceptions (u8)
and of ids (u8), the exceptions' places (u8 each) and values (u32 each), then 128 differences to the
least id of ``width`` bits each, lowest bit first. The width is the one that fits nine tenths of the
block; larger differences are exceptions, packed as 0 and patched after unpacking. All numbers are
little-endian. ``block_starts`` lets a reader unpack any block alone.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from .common import text_of
from .hashing import distinct_pieces

BLOCK = 128
FIT = 0.9                  # share of a block's differences that its width must hold
SEGMENT = 1 << 16          # ids after which a segment ends, at the end of a document
END = 0                    # id after each document
SCHEMA = ("part int, segment int, start bigint, doc_ids array<bigint>, doc_lens array<int>, "
          "block_starts array<int>, payload binary")


# ---- blocks ------------------------------------------------------------------------------------
HEAD = 7                   # bytes before a block's exceptions: least id, width, exceptions, ids


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Payload and block starts of an array of ids."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return b"", np.zeros(0, np.int32)
    padded = np.concatenate([ids, np.full(n_blocks * BLOCK - len(ids), ids[-1])]).astype(np.uint32)
    rows = padded.reshape(n_blocks, BLOCK)
    least = rows.min(1)
    diff = rows - least[:, None]
    nth = int(np.ceil(FIT * BLOCK)) - 1
    fit = np.partition(diff, nth, axis=1)[:, nth]
    width = np.ceil(np.log2(fit.astype(np.float64) + 1)).astype(np.int64)
    odd = diff >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n = odd.sum(1)
    size = HEAD + 5 * n + BLOCK // 8 * width
    starts = np.cumsum(size) - size
    out = np.zeros(size.sum(), np.uint8)
    head = np.empty((n_blocks, HEAD), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5], head[:, 6] = width, n, BLOCK
    head[-1, 6] = len(ids) - (n_blocks - 1) * BLOCK
    out[starts[:, None] + np.arange(HEAD)] = head
    places, values = np.nonzero(odd)[1].astype(np.uint8), diff[odd].astype("<u4")
    at = np.repeat(starts + HEAD, n) + _within(n)
    out[at] = places
    at = np.repeat(starts + HEAD + n, n) + 4 * _within(n)
    out[at[:, None] + np.arange(4)] = values.view(np.uint8).reshape(-1, 4)
    kept = np.where(odd, np.uint32(0), diff)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        bits = np.unpackbits(kept[own].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=w, bitorder="little")
        data = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
        out[(starts + HEAD + 5 * n)[own][:, None] + np.arange(data.shape[1])] = data
    return out.tobytes(), starts.astype(np.int32)


def unpack(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``."""
    raw, starts = np.frombuffer(payload, np.uint8), np.asarray(starts, np.int64)
    head = raw[starts[:, None] + np.arange(HEAD)]
    least = head[:, :4].copy().view("<u4")
    width, n, sizes = (head[:, i].astype(np.int64) for i in (4, 5, 6))
    diff = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        data = raw[(starts + HEAD + 5 * n)[own][:, None] + np.arange(BLOCK * w // 8)]
        bits = np.zeros((len(own) * BLOCK, -(-w // 8) * 8), np.uint8)
        bits[:, :w] = np.unpackbits(data, axis=1, bitorder="little").reshape(-1, w)
        value = np.zeros((len(bits), 4), np.uint8)
        value[:, :-(-w // 8)] = np.packbits(bits, axis=1, bitorder="little")
        diff[own] = value.view("<u4").reshape(-1, BLOCK)
    block = np.repeat(np.arange(len(starts)), n)
    places = raw[np.repeat(starts + HEAD, n) + _within(n)]
    values = raw[(np.repeat(starts + HEAD + n, n) + 4 * _within(n))[:, None] + np.arange(4)]
    diff[block, places] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    full = diff + least
    return full.reshape(-1)[:BLOCK * (len(starts) - 1) + sizes[-1]] if (
        len(sizes) and (sizes[:-1] == BLOCK).all()) else full[np.arange(BLOCK) < sizes[:, None]]


# ---- tokenizing --------------------------------------------------------------------------------
# The tokenizer first splits a text at white space, so it may be cut wherever white space begins
# without changing its ids; a piece is white space and the word after it. Texts with white space
# other than ASCII's are encoded as they are.
_FAR_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_FAR_BYTES = (b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80",
              b"\xe2\x81\x9f", b"\xe3\x80\x80")
# Characters that byte-level tokenizers give the bytes: printable ones stand for themselves, the
# others are numbered on from 256.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {**{b: chr(b) for b in _SHOWN},
               **{b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}}
# A plain piece is a space and ASCII characters but ' and <, or a space, any letters, and full stops and
# commas. The tokenizer splits it into runs of letters, digits and other characters, the space with
# the first, and merges bytes within these. Where no token reaches from one such part to the next or
# to a space, merging many plain pieces at once gives the same ids.
_PLAIN = re.compile(rb" [!-&(-;=-~]+").fullmatch
_LETTER, _DIGIT, _OTHER = "(?:[^\\W\\d_]|[\udc80-\udcff])", "[0-9]", "[!-/:-@\\[-`{-~]"
_ACROSS = re.compile(f"{_LETTER}(?:{_DIGIT}|{_OTHER}| )|{_DIGIT}(?:{_LETTER}|{_OTHER}| )|{_OTHER}(?:{_LETTER}|{_DIGIT}| )").search
_CHAR_BYTES = {c: b for b, c in _BYTE_CHARS.items()}
RUN = 256                  # plain pieces that are merged at once


def _reaches_across(token: str) -> bool:
    """Whether a token holds the end of one part of a plain piece and the beginning of the next."""
    text = bytes(_CHAR_BYTES.get(c, 0) for c in token).decode("utf-8", "surrogateescape")
    return "'" not in text and "<" not in text and bool(_ACROSS(text))


def _is_plain(piece: bytes) -> bool:
    if piece.isascii():
        return _PLAIN(piece) is not None
    return piece[0] == 0x20 and piece.decode("utf-8", "surrogatepass")[1:].rstrip(".,").isalpha()


class PieceEncoder:
    """Encodes texts piece by piece and remembers the ids of up to ``limit`` frequent pieces."""

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.known: dict[bytes, int] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = not any(map(_reaches_across, vocab)) and all("'" in t or "<" in t for t in added)
        self.bytes = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)    # a token has a character for each byte
        self.bytes[list(vocab.values())] = [len(t) for t in vocab]
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.size, self.hits = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the half that was asked for most."""
        keep = np.sort(np.argsort(-self.hits, kind="stable")[:self.limit // 2])
        pieces = list(self.known)
        size, first = self.size[keep], self.first[keep]
        ends = np.cumsum(size)
        self.ids = self.ids[np.repeat(first - (ends - size), size) + np.arange(ends[-1])]
        self.first, self.size, self.hits = ends - size, size, self.hits[keep] // 2
        self.known = {pieces[i]: n for n, i in enumerate(keep.tolist())}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of plain pieces and their number by piece, merged many pieces at once.

        The ids are dealt to the pieces by the bytes that each stands for; None if one reaches over an end.
        """
        found: list[int] = []
        for a in range(0, len(pieces), RUN):
            run = b"".join(pieces[a:a + RUN]).decode("latin-1").translate(_BYTE_CHARS)
            found += [t.id for t in self.tokenizer.model.tokenize(run)]
        ids = np.array(found, np.uint32)
        upto = np.concatenate([[0], np.cumsum(self.bytes[ids])])
        stops = np.cumsum([len(p) for p in pieces])
        ends = np.searchsorted(upto, stops)
        if upto[-1] != stops[-1] or not np.array_equal(upto[ends], stops):
            return None
        return ids, np.diff(ends, prepend=0)

    def _learn(self, pieces: list[bytes]) -> None:
        plain = [p for p in pieces if _is_plain(p)] if self.apart else []
        found = self._joined(plain) if plain else None
        if found is not None:
            self._keep(plain, *found)
            pieces = [p for p in pieces if p not in self.known]
        whole = self._whole([p.decode("utf-8", "surrogatepass") for p in pieces])
        self._keep(pieces, np.array([i for x in whole for i in x], np.uint32), np.array([len(x) for x in whole], np.int64))

    def _keep(self, pieces: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.hits = np.concatenate([self.hits, np.zeros(len(size), np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with END after it, and their number by text."""
        if len(self.known) > self.limit:
            self._forget()
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"".join(raw)
        whole = []
        if any(x in joined for x in _FAR_BYTES):
            whole = [i for i, t in enumerate(texts) if _FAR_SPACE.search(t)]
            for i in whole:
                raw[i] = b""
            joined = b"".join(raw)
        stops = np.cumsum([len(x) for x in raw])
        first, end, kind, pick = distinct_pieces(joined, stops)
        pieces = [joined[a:b] for a, b in zip(first[pick].tolist(), end[pick].tolist())]
        own = np.array([self.known.get(p, -1) for p in pieces], np.int64)
        new = np.flatnonzero(own < 0)
        if len(new):
            found = [pieces[i] for i in new.tolist()]
            self._learn(found)
            own[new] = [self.known[p] for p in found]
        self.hits += np.bincount(own, np.bincount(kind, minlength=len(own)), len(self.hits)).astype(np.int64)
        at = own[kind]
        size = self.size[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.first[at] - upto[:-1], size) + np.arange(upto[-1])]
        ends = upto[np.searchsorted(end, stops, "right")]
        if whole:
            parts = np.split(ids, ends[:-1])
            for i, found in zip(whole, self._whole([texts[i] for i in whole])):
                parts[i] = np.array(found, np.uint32)
            ids, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return np.insert(ids, ends, END), np.diff(np.concatenate([[0], ends])) + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _slices(texts: list[str], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _writer(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        segment, start = 0, 0
        docs, lens, ids, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            payload, starts = pack(np.concatenate(ids))
            return pd.DataFrame([(part, segment, start, docs, lens, starts.tolist(), payload)],
                                columns=["part", "segment", "start", "doc_ids", "doc_lens", "block_starts", "payload"])

        for batch in batches:
            texts = batch["text"].tolist()
            doc_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"].tolist()]
            for a, b in _slices(texts):
                flat, counts = encoder.encode(texts[a:b])
                ends = np.cumsum(counts)
                for doc_id, n, end in zip(doc_ids[a:b], counts.tolist(), ends.tolist()):
                    docs.append(doc_id)
                    lens.append(n)
                    ids.append(flat[end - n:end])
                    size += n
                    if size >= SEGMENT:
                        yield flush()
                        segment, start = segment + 1, start + size
                        docs, lens, ids, size = [], [], [], 0
        if docs:
            yield flush()
    return write


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str | None = None, parts: int | None = None) -> str:
    """Write the token ids of ``docs`` in ascending order of doc_id; returns the folder.

    ``tokenizer_path`` is a file that every executor has. Rows without doc_id come first, repeated
    doc_ids follow each other in the order of their texts, null texts are empty (just the end id).
    Each part is a range of doc_ids that one task encodes as a stream, never holding more than a
    batch and a segment. Other columns are not read.
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, "tokens")
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    ordered = (d.repartitionByRange(parts or shuffle_partitions(spark), F.asc_nulls_first("doc_id"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text"))
    ordered.mapInPandas(_writer(tokenizer_path), SCHEMA).write.parquet(out)
    return out


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            ids = unpack(row.payload, row.block_starts).astype("<u4")
            lens = np.asarray(row.doc_lens, np.int64)
            ends = np.cumsum(lens)
            raw = memoryview(ids.tobytes())
            yield pd.DataFrame({
                "part": row.part, "doc_id": pd.array([None if x is None or x != x else int(x) for x in row.doc_ids], "Int64"),
                "offset": row.start + ends - lens, "n_tokens": lens,
                "ids_crc32": [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lens.tolist())]})


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    ``start`` counts the ids of all documents before it: the part's place (running sums over one row
    per part, broadcast: as many rows as the files have parts) and the place within the part.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    sizes = (files.groupBy("part").agg(F.sum(F.aggregate("doc_lens", F.lit(0).cast("bigint"),
                                                         lambda s, n: s + n)).alias("n")))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("place"))
    docs = files.mapInPandas(_described, "part int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")
    return (docs.join(F.broadcast(places), "part")
            .select("doc_id", (F.col("place") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def _ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            ids = unpack(row.payload, row.block_starts).astype(np.int64)
            parts = np.split(ids, np.cumsum(row.doc_lens)[:-1])
            docs = pd.array([None if x is None or x != x else int(x) for x in row.doc_ids], "Int64")
            yield pd.DataFrame({"doc_id": docs, "ids": parts})


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids): every document's ids with the end id."""
    return spark.read.schema(SCHEMA).parquet(folder).mapInPandas(_ids, "doc_id bigint, ids array<bigint>")
