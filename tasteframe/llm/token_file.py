"""Token ids of documents as files of independently coded, checksummed blocks, and the way back."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe.llm.common import pieces
from tasteframe.llm.id_coder import decode, encode
from tasteframe.scratch import fresh_path

#: Ids of a block at most, and of the short blocks of a small file at least; blocks coded side by side, at most and wished for.
BLOCK, SHORT, LANES, WISHED = 8192, 1024, 1024, 256
SCHEMA = "file int, block int, at long, n int, data binary, doc_id array<long>, doc_at array<long>, doc_n array<long>"
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
_POLY = 0xEDB88320
#: A word of letters whose case and trailing signs the tokenizer surely treats by themselves.
_PLAIN = re.compile(rb"([A-Za-z\x80-\xff]*[A-Za-z])([.,;:!?|]*)")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids (little-endian, four bytes each) of texts by a tokenizer of the tokenizers library, given as its JSON.

    ``by_word``: the tokenizer drops white space and looks at nothing beyond it, lower-cases, and cuts ASCII signs from letters, so that each run
    between ASCII white space is encoded by itself, once, and remembered; at most ``most`` of them at a time. Runs of ASCII letters
    go to the tokenizer's model directly. Else whole texts are encoded.
    """

    def __init__(self, json: str, by_word: bool, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word, self.most = Tokenizer.from_str(json), by_word, most
        self.known: dict[bytes, bytes] = {}
        self.plain: dict[bytes, bytes] = {}
        if by_word and [t.id for w in ("ab", "cde") for t in self.tokenizer.model.tokenize(w)] != self.tokenizer.encode(" Ab\n\tcDe ", add_special_tokens=False).ids:
            raise ValueError("this tokenizer does not encode word by word")

    def encode(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str], together: int = 2000) -> Iterator[bytes]:
        """As ``encode``, for many words at once: they are joined by blanks, and cut where the tokens begin."""
        for at in range(0, len(words), together):
            some = words[at : at + together]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            first = np.cumsum([0, *[len(w) + 1 for w in some]])
            cuts = np.searchsorted(np.fromiter((a for a, _ in found.offsets), np.int64, len(ids)), first).tolist()
            yield from (ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    def of(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self.encode([t.decode("utf-8", "replace") for t in texts])
        if len(self.known) > self.most:
            self.known.clear()
        if len(self.plain) > self.most:
            self.plain.clear()
        split = [t.split() for t in texts]
        new = set().union(*split).difference(self.known)
        cut = {}
        for word in new:
            m = _PLAIN.fullmatch(word)
            cut[word] = (m[1].lower() if m[1].isascii() else m[1], m[2]) if m else (word, b"")
        parts = sorted({p for pair in cut.values() for p in pair if p and p not in self.plain})
        letters = [p for p in parts if p.isalpha() and p.islower()]  # of bytes: ASCII letters only
        self.plain.update((p, _packed([t.id for t in self.tokenizer.model.tokenize(p.decode())])) for p in letters)
        others = [p for p in parts if p not in self.plain]
        self.plain.update(zip(others, self.encode_words([p.decode("utf-8", "replace") for p in others]), strict=True))
        self.plain[b""] = b""
        self.known.update((word, self.plain[a] + self.plain[b]) for word, (a, b) in cut.items())
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, bits reflected."""
    out = 0
    while a:
        if a & 1 << 31:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ _POLY if b & 1 else b >> 1
    return out


def crc_before(crc: int, n: int) -> int:
    """What the CRC-32 of a part adds (by xor) to that of the whole, if ``n`` bytes follow it."""
    power = 1 << 23  # x to the 8: one byte
    while n:
        if n & 1:
            crc = _times(power, crc)
        power, n = _times(power, power), n >> 1
    return crc


def write(documents: DataFrame, path: str, tokenizer: str, end: int, by_word: bool = False, digits: int = 3) -> None:
    """Write the ids of every text of ``documents`` (doc_id, text), each followed by the id ``end``, as a table of blocks in Parquet at ``path``.

    ``tokenizer`` is the path of a JSON file that the driver reads. Documents ascend by doc_id (null first; equal ids by
    a hash of the text) over the files 0, 1, ...: ranges of documents, sampled by Spark, which split a hot doc_id too. Rows are (file,
    block, at, n, data, doc_id, doc_at, doc_n): ``at`` is the position in the file of the block's first id, ``data`` the block by
    ``id_coder``, and the arrays name the documents with ids in it, each with its position in the file and its length. Ids are below 64**digits.
    Null and empty texts are the end id alone.
    """
    with open(tokenizer, encoding="utf-8") as f:
        json = f.read()
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    order = ["doc_id", "h", "tie"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", F.col("text").cast("binary").alias("text"))
    last = _packed([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, file = WordIds(json, by_word), TaskContext.get().partitionId()
        held: list[bytes] = []
        ids: list = []
        start: list[int] = []
        size: list[int] = []
        at = block = waiting = 0

        def emit(n: int, length: int) -> pa.RecordBatch:
            """The next n ids in blocks of a length."""
            nonlocal at, block, waiting
            flat = np.frombuffer(b"".join(held), "<u4")
            held[:] = [flat[n:].tobytes()]
            first, stop = np.array(start), np.array(start) + np.array(size)
            cuts = [flat[i : min(i + length, n)] for i in range(0, n, length)]
            out = []
            for cut, data in zip(cuts, encode(cuts, digits), strict=True):
                a, b = np.searchsorted(stop, at, "right"), np.searchsorted(first, at + len(cut), "left")
                out.append((file, block, at, len(cut), data, ids[a:b], start[a:b], size[a:b]))
                at, block = at + len(cut), block + 1
            done = int(np.searchsorted(stop, at, "right"))
            del ids[:done], start[:done], size[:done]
            waiting -= n
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        for b in pieces(batches):
            for doc_id, made in zip(b.column(0).to_pylist(), words.of(b.column(1).to_pylist()), strict=True):
                ids.append(doc_id)
                start.append(at + waiting)
                size.append(len(made) // 4 + 1)
                held += [made, last]
                waiting += size[-1]
            while waiting >= LANES * BLOCK:
                yield emit(LANES * BLOCK, BLOCK)
        if waiting:
            yield emit(waiting, min(BLOCK, max(SHORT, -(-waiting // WISHED))))

    dealt.mapInArrow(run, SCHEMA).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray]]:
    """Each block's other columns and its ids."""
    held: list[dict] = []

    def some() -> Iterator[tuple[dict, np.ndarray]]:
        for row, ids in zip(held, decode([r["data"] for r in held]), strict=True):
            if len(ids) != row["n"]:
                raise ValueError(f"block {row['block']} of file {row['file']} holds {len(ids)} ids, not {row['n']}")
            yield row, ids
        held.clear()

    for b in pieces(batches):
        for row in b.to_pylist():
            held.append(row)
            if len(held) == LANES:
                yield from some()
    yield from some()


def _parts(row: dict, ids: np.ndarray) -> Iterator[tuple[int | None, int, int, int, np.ndarray]]:
    """(doc_id, position in the file, length, ids of it that come after the block, ids in the block) of the block's documents."""
    for doc_id, at, n in zip(row["doc_id"], row["doc_at"], row["doc_n"], strict=True):
        yield doc_id, at, n, max(0, at + n - row["at"] - row["n"]), ids[max(0, at - row["at"]) : at + n - row["at"]]


def read(table: DataFrame) -> DataFrame:
    """(file, doc_id, doc_at, doc_n, offset, ids) of a table of blocks, a row per document and block: ``ids`` are those from ``offset`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _decoded(batches):
            out = [(row["file"], d, at, n, n - after - len(part), part) for d, at, n, after, part in _parts(row, ids)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "doc_id", "doc_at", "doc_n", "offset", "ids"])

    return table.mapInArrow(run, "file int, doc_id long, doc_at long, doc_n long, offset long, ids array<long>")


def digests(table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of a table of blocks, a row per document, from the decoded ids.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned 32-bit integers. Parts of a
    document in several blocks are put together by xor, in any order; a missing block is an error, as is a damaged one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "doc_id", "doc_at", "doc_n", "n", "crc"])
            out.clear()
            return made

        for row, ids in _decoded(batches):
            out += [(row["file"], d, at, n, len(part), crc_before(zlib.crc32(part), 4 * after)) for d, at, n, after, part in _parts(row, ids)]
            if len(out) > 20_000:
                yield emit()
        if out:
            yield emit()

    parts = table.mapInArrow(run, "file int, doc_id long, doc_at long, doc_n long, n long, crc long")
    docs = parts.groupBy("file", "doc_at", "doc_id", "doc_n").agg(F.sum("n").alias("n"), F.bit_xor("crc").alias("crc"))
    whole = F.when(F.col("n") == F.col("doc_n"), F.col("n")).otherwise(F.raise_error(F.lit("a document lacks a block")).cast("long"))
    sizes = table.groupBy("file").agg(F.sum("n").alias("ids"))
    before = sizes.select("file", (F.sum("ids").over(W.orderBy("file")) - F.col("ids")).alias("before"))
    return docs.join(before, "file").select("doc_id", (F.col("before") + F.col("doc_at")).alias("start"), whole.alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def round_trip(documents: DataFrame, tokenizer: str, end: int, by_word: bool = False, digits: int = 3) -> DataFrame:
    """``documents`` written by ``write`` to the shared folder and read back: (doc_id, start, n_tokens, ids_crc32), a row per row.

    Repeated rows and rows without doc_id are documents of their own; an empty table gives no rows; other columns are ignored. Eager.
    """
    spark = documents.sparkSession
    path = fresh_path(spark, "token-files")
    write(documents, path, tokenizer, end, by_word, digits)
    return digests(spark.read.schema(SCHEMA).parquet(path))
