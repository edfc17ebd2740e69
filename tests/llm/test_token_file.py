"""Token files: the coder by itself, ids against the tokenizers library, and damage."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe.llm import id_coder, token_file

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def expected(docs, path: str, end: int) -> list:
    """(doc_id, n_tokens, ids_crc32) in the order of the files, by the library on whole texts."""
    t = tokenizers.Tokenizer.from_file(path)
    rows = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, end]
        rows.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def checked(docs, path: str, end: int, by_word: bool) -> list:
    got = sorted(map(tuple, token_file.round_trip(docs, path, end, by_word).collect()), key=lambda r: r[1])
    want = expected(docs, path, end)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted(map(repr, ((r[0], r[2], r[3]) for r in got))) == sorted(map(repr, want))
    at = 0
    for r in got:
        assert r[1] == at
        at += r[2]
    return got


def test_blocks_come_back():
    rng = np.random.default_rng(0)
    for sizes, most, digits in (([0, 1, 5, 300, 77], 65536, 3), ([1000] * 3, 5, 1), ([900, 0, 2000], 4000, 2), ([2000, 3000], 2**24, 4), ([], 9, 3)):
        blocks = [rng.integers(0, most, n) for n in sizes]
        made = id_coder.encode(blocks, digits)
        assert [x.tolist() for x in id_coder.decode(made)] == [b.tolist() for b in blocks]
        for b, m in zip(blocks, made, strict=True):
            assert id_coder.encode([b], digits) == [m]  # a block does not depend on those coded with it


def test_orders_learn():
    """Ids that follow from the two before cost little, and every block starts anew."""
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 40_000, 4000)
    cycle = np.tile(rng.integers(0, 40_000, 40), 100)
    skewed = np.where(rng.random(4000) < 0.9, 7, noise)
    small, pattern, random_ids = (8 * len(id_coder.encode([b])[0]) / 4000 for b in (skewed, cycle, noise))
    assert pattern < 1.5 and small < 4 and random_ids > 12


def test_damage_is_seen():
    block = id_coder.encode([np.arange(500)])[0]
    for bad in (block[:-1], block[:40] + b"\x00\x01" + block[42:], b"XXXX" + block[4:], b"", block + b"1"):
        with pytest.raises(ValueError, match="damaged"):
            id_coder.decode([bad])


def test_crc_of_parts():
    data = os.urandom(5000)
    for cut in (0, 1, 700, 4999, 5000):
        assert token_file.crc_before(zlib.crc32(data[:cut]), 5000 - cut) ^ zlib.crc32(data[cut:]) == zlib.crc32(data)


def test_words_equal_whole_texts():
    rng = random.Random(1)
    signs = [*"aAbz'’ \n\t\x0b\x85\xa0 .,!|<>09é́ÀßİIK日本🙂̇ẞΣς", "<|endoftext|>", "'s", "'LL", " don't ", "<|startoftext|>", "\x00", "﻿", "ͅ"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000)]
    with open(WORDS, encoding="utf-8") as f:
        words = token_file.WordIds(f.read(), True, most=300)  # forgets now and then
    t = tokenizers.Tokenizer.from_file(WORDS)
    for at in range(0, 2000, 250):
        some = texts[at : at + 250]
        assert words.of([x.encode() for x in some]) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in some]


def test_round_trip(messy, no_docs, monkeypatch):
    rows = checked(messy, WORDS, 1, True)
    assert sum(r[0] is None for r in rows) == 2 and max(r[2] for r in rows) > 2 * token_file.BLOCK
    assert token_file.round_trip(no_docs, WORDS, 1).collect() == []


def test_other_tokenizers_and_the_ids_themselves(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["A text  with spaces", None, "", "ǘ <|endoftext|> 日本", "word " * 4000])], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    checked(docs, path, 50256, False)
    place = spark.conf.get("spark.checkpoint.dir") + f"/ids-{os.urandom(4).hex()}"
    token_file.write(docs, place, path, 50256)
    table = spark.read.parquet(place)
    t = tokenizers.Tokenizer.from_file(path)
    ids: dict = {}
    for r in token_file.read(table).orderBy("doc_id", "offset").collect():
        assert r.offset == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += r.ids
    assert ids == {r.doc_id: [*t.encode(r.text or "", add_special_tokens=False).ids, 50256] for r in docs.collect()}
    damaged = table.withColumn("data", F.overlay("data", F.lit(b"\x07\x07").cast("binary"), 30))
    for bad, what in ((damaged, "damaged"), (table.filter("not (block = 1 and array_contains(doc_id, 4))"), "lacks a block")):
        with pytest.raises(Exception, match=what):
            token_file.digests(bad).collect()
