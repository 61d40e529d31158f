import gc
import random
import string
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from cases import ROWS, awkward, clashing, empty
from tokenizers import Tokenizer

from sensoria.llm import packing
from sensoria.llm.words import WordTable


def check(rows, pieces, sequence):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at : at + p["length"]].tobytes()) == zlib.crc32(bytes(p["ids"]))
            at += p["length"]
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == sequence or at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_whole_table_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], pieces, 4096)


def test_special_words_are_the_tokenizers(spark):
    texts = ["don't <|endoftext|> x", "İstanbul É é", "a b \x1c c", "3.14% (ok)!!", "² x́ " * 3, "ſ K Å"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    check(list(enumerate(texts)), packing.pack(docs).collect(), 4096)


def test_odd_words_are_the_tokenizers():
    """Signs, digits, accents, capitals and control tokens in any case, next to each other."""
    rng = random.Random(7)
    tokens = packing.WordTokens(None)
    assert tokens.mixed
    signs = [*string.printable, "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "'ll", "'RE", "\x1c", "\x85", "\u0301", "\u2028"]
    signs += [*"éÉßŉǆǅσςΣΐйЙі²½ªʰ漢字ﬁİıſK가ᄀ", "é", "<\u0338"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    flat, number = tokens.encode([None, "".encode(), *(text.encode() for text in texts)])
    expected = [tokens.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert number.tolist() == [0, 0, *map(len, expected)]
    assert flat.tolist() == [i for ids in expected for i in ids]


def test_held_words_are_small():
    """What a task keeps of its words: their bytes and few more, no objects."""
    words = [f"{i * 7919:x}" for i in range(200_000)]
    text = " ".join(words).encode()
    gc.collect()
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    table = WordTable()
    assert table  # an empty one is a table too
    table.batch([text])
    added = table.fresh()
    assert len(added) == 200_000 and added[-1] == words[-1].encode()
    del added
    gc.collect()
    held = pa.total_allocated_bytes() - held + tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 12_000_000


def test_plain_words_come_from_the_model():
    """Words of a-z, alone and among others, have the ids the whole tokenizer gives."""
    rng = random.Random(4)
    tokens = packing.WordTokens(None)
    assert tokens.plain
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    words += ["s", "t", "re", "x" * 3000, "été", "漢字", "a1", "b.c", "'s", "Straße", "K"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "?!", "\n"]) for _ in range(40)) for _ in range(200)]
    flat, number = tokens.encode([text.encode() for text in texts])
    expected = [tokens.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert number.tolist() == [len(ids) for ids in expected]
    assert flat.tolist() == [i for ids in expected for i in ids]


def test_windows_hold_the_target_shares(spark):
    rows = [(i, "alpha beta gamma delta " * 40, "big" if i % 4 else "small") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    s = packing.Settings(sequence=256, window_sequences=2, shares={"big": 1.0, "small": 1.0})
    pieces = packing.pack(docs, s).collect()
    check([(r[0], r[1]) for r in rows], pieces, 256)
    window = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        window[(p["sequence_id"] * 256) // 512][p["queue"]] += p["length"]
    small = sum(p["length"] for p in pieces if p["queue"] == "small")
    for number in range(2 * small // 512 - 1):  # until the smaller queue runs dry
        assert abs(window[number]["big"] - 256) <= 1


def test_many_sources_keep_their_shares(spark):
    rows = [(i, "alpha beta gamma delta " * 10, ("big", "small")[i % 2] if i < 80 else f"site{i % 20}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shares in ({"big": 3.0, "small": 1.0}, None):
        s = packing.Settings(sequence=64, window_sequences=4, shares=shares, max_queues=4)
        pieces = packing.pack(docs, s).collect()
        check([(r[0], r[1]) for r in rows], pieces, 64)
        total = sum(p["length"] for p in pieces)
        sizes, served = defaultdict(int), defaultdict(lambda: defaultdict(int))
        for p in pieces:
            sizes[p["queue"]] += p["length"]
            served[p["sequence_id"] * 64 // 256][p["queue"]] += p["length"]
        assert set(sizes) == {r[2] for r in rows}
        if shares:  # until the first of the two runs dry
            for number in range(int(sizes["big"] / 0.75) // 256):
                assert abs(served[number]["big"] - 192) <= 1 and abs(served[number]["small"] - 64) <= 1
        else:
            for q, n in sizes.items():
                run = 0
                for number in range(total // 256):
                    run += served[number][q]
                    assert abs(run - (number + 1) * 256 * n / total) <= 1


def test_deficits_stay_below_one_token():
    plan = packing.schedule({"a": 10_007, "b": 3, "c": 5_000}, packing.Settings(sequence=64, window_sequences=3))
    taken = sorted(
        (position, length) for q, n in (("a", 10_007), ("b", 3), ("c", 5_000)) for _, position, length in plan.place(q, 0, n)
    )
    at = 0
    for position, length in taken:
        assert position == at
        at += length
    assert at == 15_010
    split = [run for first in range(0, 10_007, 101) for run in plan.place("a", first, min(first + 101, 10_007))]
    assert sum(length for _, _, length in split) == 10_007


def test_awkward_rows(spark):
    pieces = packing.pack(clashing(awkward(spark))).collect()
    assert len({(p["doc_id"]) for p in pieces}) == len({r[0] for r in ROWS})
    assert [p["doc_tokens"] for p in pieces if p["doc_id"] == 3] == [1]
    assert packing.pack(empty(spark)).count() == 0
    hashed = packing.pack(awkward(spark), packing.Settings(max_queues=2)).collect()
    assert sum(p["length"] for p in hashed) == sum(p["length"] for p in pieces)


def test_memory_goes_back_after_each_batch(monkeypatch):
    """Between batches a task holds its words only."""
    calls = []
    monkeypatch.setattr(packing, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(packing, "small_batches", lambda spark: spark)

    class Rows:
        sparkSession, dtypes = None, [("doc_id", "bigint")]

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Context:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing.F, "col", lambda name: _Column())
    monkeypatch.setattr(packing.F, "lit", lambda value: value)
    monkeypatch.setattr(packing.F, "coalesce", lambda *columns: _Column())
    monkeypatch.setattr(packing.TaskContext, "get", classmethod(lambda cls: Context))
    run = packing.tokenised(Rows(), packing.Settings(), "text", "doc_id", "source")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "queue": ["a"], "text": ["one two"]})
    assert len(list(run(iter([batch, batch, batch])))) == 3
    assert len(calls) == 4


class _Column:
    def cast(self, kind):
        return self

    def alias(self, name):
        return self
