"""Packing token ids into training sequences, neighbours by lexical retrieval.

Each partition is worked through in shards (``SHARD_BYTES`` of text or ``SHARD_DOCS`` documents). A shard gets a
BM25 inverted index over token ids. A window starts with a seed: what is left of a cut document, or the
next unused one; the index returns the seed's unused neighbours, best first, and they fill the
window. The last one is cut where the window ends, and what is left seeds the next window, so every
window is full. A window that a shard leaves open goes on in the next shard; what a partition leaves
open is split into sequences whose lengths are powers of two, which need no padding. Nothing is shuffled
and nothing is sent but the path of the vocabulary; a partition's memory is that of one shard.

Ids are those of the given tokenizer without its special ids, and ``END`` after each document. Most texts are
split into pieces by vectorised code (the byte-level pattern's rules for letters, digits, signs and blanks);
each distinct piece of a shard is encoded once. Texts with apostrophes go through the encoder whole, and
texts outside the Latin, Greek and Cyrillic blocks or with the end-of-text mark through ``tokenizers`` itself.

Cases: a NULL text is an empty one, and an empty document is its end id alone. Repeated rows are packed each on
its own. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.support import Rolling, arrow_rows, give_back, ship, slices, text_slices

SEQUENCE, END = 2048, 1
SHARD_BYTES, SHARD_DOCS = 4 << 20, 2048
QUERY_TERMS = 24
_KNOWN = 400_000
K1, B = 1.2, 0.75
_LATIN = 0x0500  # code points below it are split by vectorised code


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of many texts at once, equal to those of ``tokenizers`` with the same file."""

    def __init__(self, path: str):
        import tiktoken
        import unicodedata
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        # Byte-level vocabularies show bytes as printable characters: these stand for themselves, the rest follow U+0100.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(shown[c] for c in t): i for t, i in vocabulary.items() if all(c in shown for c in t) and t != "<|endoftext|>"}
        import public_tokenizers

        self.fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            self.size[i] = len(t)
        kinds = np.zeros(_LATIN, np.uint8)  # 0 signs, 1 letters, 2 digits, 3 blanks
        for c in range(_LATIN):
            kinds[c] = {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 0)
        kinds[[*range(9, 14), 32, 0x85, 0xA0]] = 3
        self.kinds = kinds
        self.single: dict[bytes, list[int]] = {}
        # Pieces seen in earlier shards: sorted hashes, and where their ids are in ``pool``.
        self.known, self.place, self.pool = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), np.zeros(0, np.int64)

    def slow(self, text: str) -> np.ndarray:
        if "<|endoftext|>" in text or (text and ord(max(text)) >= _LATIN):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.fast.encode_ordinary(text), np.int64)

    def pieces(self, c: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pieces start, in characters; ``edges`` are the documents' starts and the end."""
        n = len(c)
        kind = self.kinds[c]
        new = np.ones(n, bool)
        new[1:] = kind[1:] != kind[:-1]
        new[edges[edges < n]] = True
        runs = np.flatnonzero(new)
        stops = np.append(runs[1:], n)
        blank = kind[runs] == 3
        closes = np.isin(stops, edges)  # the run ends its document
        # Other runs take one plain blank before them along.
        solid = runs[~blank]
        first = np.isin(solid, edges)
        takes = ~first & (c[np.maximum(solid - 1, 0)] == 32)
        out = [solid - takes]
        b0, b1, end = runs[blank], stops[blank], closes[blank]
        long = b1 - b0 >= 2
        alone = end | long | (c[b0] != 32)
        out.append(b0[alone])
        out.append((b1 - 1)[long & ~end])
        start = np.zeros(n, bool)
        start[np.concatenate(out)] = True
        return np.flatnonzero(start)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, each with END, and where each begins."""
        m = len(offsets) - 1
        per_doc: list[np.ndarray | None] = [None] * m
        raw = data.tobytes()
        plain = []
        highest = np.zeros(m, np.uint8)  # 0xD4 and more lead the bytes of code points of U+0500 and more
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            highest[some] = np.maximum.reduceat(data, offsets[some])
        for d in range(m):
            part = raw[offsets[d] : offsets[d + 1]]
            if b"'" in part or b"<|endoftext|>" in part or highest[d] >= 0xD4:
                per_doc[d] = self.slow(part.decode())
            elif part:
                plain.append(d)
        if plain:
            joined = b"".join(raw[offsets[d] : offsets[d + 1]] for d in plain)
            bytes_ = np.frombuffer(joined, np.uint8)
            sizes = np.array([offsets[d + 1] - offsets[d] for d in plain])
            c = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
            width = 1 + (c >= 0x80).astype(np.int64)
            at = np.concatenate(([0], np.cumsum(width)))  # a character's first byte
            byte_edges = np.concatenate(([0], np.cumsum(sizes)))
            edges = np.searchsorted(at, byte_edges)
            starts = self.pieces(c, edges)
            b0 = at[starts]
            b1 = np.append(b0[1:], len(bytes_))
            hashes, first, back = np.unique(Rolling(bytes_).ranges(b0, b1), return_index=True, return_inverse=True)
            ids, begin, lens = self.remembered(hashes, bytes_, b0[first], b1[first])
            n = lens[back]
            total = np.concatenate(([0], np.cumsum(n)))
            flat = ids[np.repeat(begin[back] - total[:-1], n) + np.arange(total[-1])]
            cut = total[np.searchsorted(b0, byte_edges)]
            for k, d in enumerate(plain):
                per_doc[d] = flat[cut[k] : cut[k + 1]]
        none = np.zeros(0, np.int64)
        sizes = np.array([0 if x is None else len(x) for x in per_doc]) + 1
        where = np.concatenate(([0], np.cumsum(sizes)))
        out = np.full(where[-1], END, np.uint16)
        for d, x in enumerate(per_doc):
            out[where[d] : where[d + 1] - 1] = none if x is None else x
        return out, where

    def remembered(self, hashes: np.ndarray, data: np.ndarray, b0: np.ndarray, b1: np.ndarray):
        """``distinct`` for the pieces not seen before; keeps up to ``_KNOWN`` pieces."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        old = self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), bool)
        ids, begin, lens = self.distinct(data, b0[~old], b1[~old])
        where = np.empty((len(hashes), 2), np.int64)
        where[old] = self.place[at[old]]
        where[~old, 0], where[~old, 1] = begin + len(self.pool), lens
        pool = np.concatenate((self.pool, ids))
        if len(self.known) + len(begin) <= _KNOWN:
            known = np.concatenate((self.known, hashes[~old]))
            order = np.argsort(known)
            self.known, self.place, self.pool = known[order], np.concatenate((self.place, where[~old]))[order], pool
        return pool, where[:, 0], where[:, 1]

    def distinct(self, data: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: all of them, where each piece's begin, and how many it has.

        Pieces of one blank and more keep apart when put together, so they are encoded in one go and
        told apart by their bytes; the others are encoded one by one and remembered.
        """
        size = b1 - b0
        after = data[np.minimum(b0 + 1, len(data) - 1)]
        led = (data[b0] == 32) & (size > 1) & (after > 32) & (after != 0xC2)
        bulk = np.flatnonzero(led)
        begin, lens = np.zeros(len(b0), np.int64), np.zeros(len(b0), np.int64)
        ids = np.zeros(0, np.int64)
        if len(bulk):
            n = size[bulk]
            stop = np.cumsum(n)
            put = data[np.repeat(b0[bulk] - (stop - n), n) + np.arange(stop[-1])]
            ids = np.array(self.fast.encode_ordinary(put.tobytes().decode()), np.int64)
            ends = np.searchsorted(np.cumsum(self.size[ids]), stop) + 1
            lens[bulk] = np.diff(ends, prepend=0)
            begin[bulk] = ends - lens[bulk]
        more: list[int] = []
        raw = data.tobytes()
        for k, i, j in zip(np.flatnonzero(~led).tolist(), b0[~led].tolist(), b1[~led].tolist(), strict=True):
            piece = raw[i:j]
            own = self.single.get(piece)
            if own is None:
                if len(self.single) > 100_000:
                    self.single.clear()
                own = self.single[piece] = self.fast.encode_ordinary(piece.decode())
            begin[k], lens[k] = len(ids) + len(more), len(own)
            more += own
        return np.concatenate((ids, np.array(more, np.int64))), begin, lens


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Index:
    """BM25 over a shard's token ids: for every id, the documents that have it and their weights."""

    def __init__(self, ids: np.ndarray, where: np.ndarray):
        n = len(where) - 1
        lens = np.diff(where)
        keys = ids.astype(np.int32 if n <= SHARD_DOCS else np.int64) * n + np.repeat(np.arange(n), lens)
        keys = np.sort(keys.astype(np.int32) if n <= SHARD_DOCS else keys)
        runs = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        tf = np.diff(runs, append=len(keys))
        term, self.doc = np.divmod(keys[runs], n)
        begin = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        df = np.diff(begin, append=len(term))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lens / max(lens.mean(), 1))
        self.weight = np.repeat(idf * (df > 1), df) * tf * (K1 + 1) / (tf + norm[self.doc])
        self.begin, self.end, self.n = begin, begin + df, n
        # Each document's most telling terms that others have too.
        number = np.repeat(np.arange(len(df)), df)
        order = np.argsort(self.doc.astype(np.uint16) if n <= SHARD_DOCS else self.doc, kind="stable")
        at = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.query = []
        for d in range(n):
            own = order[at[d] : at[d + 1]]
            if len(own) > QUERY_TERMS:
                own = own[np.argpartition(-self.weight[own], QUERY_TERMS)[:QUERY_TERMS]]
            self.query.append(np.sort(number[own[self.weight[own] > 0]]))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share terms with the seed, best first."""
        terms = self.query[seed]
        if not len(terms):
            return terms
        posting = np.concatenate([np.arange(self.begin[t], self.end[t]) for t in terms])
        score = np.bincount(self.doc[posting], weights=self.weight[posting], minlength=self.n)
        score[~unused] = 0
        found = np.flatnonzero(score > 0)
        return found[np.lexsort((found, -score[found]))]


class Packer:
    """Fills windows; keeps the open one between shards."""

    def __init__(self, base: int):
        self.base, self.number, self.open = base, 0, []
        self.rows: list[tuple] = []

    def close(self, length: int) -> None:
        """End a sequence after ``length`` ids of the open window."""
        at, rest = 0, []
        for doc, start, ids, total in self.open:
            take = min(len(ids), length - at)
            if take:
                self.rows.append((doc, start, take, zlib.crc32(ids[:take].astype("<u4").tobytes()), total, self.base + self.number, at, ids[:take]))
            if take < len(ids):
                rest.append((doc, start + take, ids[take:], total))
            at += take
        self.open = rest
        self.number += 1

    def room(self) -> int:
        return SEQUENCE - sum(len(x[2]) for x in self.open)

    def shard(self, names: list, ids: np.ndarray, where: np.ndarray) -> None:
        n = len(names)
        index = Index(ids, where)
        unused = np.ones(n, bool)
        order = iter(range(n))
        left = n
        seed, queue = None, iter(())
        while left:
            d = next((int(x) for x in queue if unused[x]), None)
            if d is None:
                d = next(x for x in order if unused[x])
                seed, queue = d, iter(index.neighbours(d, unused))
            unused[d] = False
            left -= 1
            own = ids[where[d] : where[d + 1]]
            self.open.append((names[d], 0, own, len(own)))
            cut = self.room() <= 0
            while self.room() <= 0:
                self.close(SEQUENCE)
            if cut:  # a window ended: the document that was cut, or the last of it, seeds the next
                seed = d
                queue = iter(index.neighbours(seed, unused)) if self.open else iter(())

    def finish(self) -> None:
        """What is still open becomes sequences of powers of two."""
        left = SEQUENCE - self.room()
        while left:
            size = 1 << (left.bit_length() - 1)
            self.close(size)
            left -= size


def in_pieces(encoder: Encoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``encode`` by slices of ``SLICE`` bytes, so that its temporaries stay small."""
    parts, ends, done = [np.zeros(0, np.uint16)], [np.zeros(1, np.int64)], 0
    for i, j in slices(offsets):
        ids, where = encoder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        parts.append(ids)
        ends.append(where[1:] + done)
        done += len(ids)
    return np.concatenate(parts), np.concatenate(ends)


def packed(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, the ids."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or default_vocabulary()  # where this executor has it
        pack = Packer(TaskContext.get().partitionId() << 40)

        def flush():
            rows, pack.rows = pack.rows, []
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            out = [pa.array(list(c), kind if k == 0 else pa.int64()) for k, c in enumerate(columns[:7])]
            if with_ids:
                names = (*names, "ids")
                out.append(pa.array([x.astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(out, names=list(names))

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            names = batch.column(0).to_pylist()
            for i, j, data, offsets in text_slices(batch, "text", SHARD_BYTES):
                for a in range(0, j - i, SHARD_DOCS):
                    z = min(a + SHARD_DOCS, j - i)
                    ids, where = in_pieces(encoder(path), data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])
                    pack.shard(names[i + a : i + z], ids, where)
                    yield flush()
        pack.finish()
        yield flush()
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
